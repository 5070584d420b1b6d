"""Word counting vocabulary: tokens, letter buckets, chunk ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: str | Column) -> Column:
    """Whitespace split of the whole text; empty text gives no tokens."""
    value = F.trim(text if isinstance(text, Column) else F.col(text), F.lit(" \t\n\r\f\x0b"))
    return F.when(F.length(value) == 0, F.array().cast("array<string>")).otherwise(F.split(value, r"\s+"))


def letter_bucket(word: str | Column) -> Column:
    """0 for a first letter up to i, 1 up to r, 2 beyond (binary order, case-folded)."""
    first = F.lower(F.substring(word, 1, 1))
    return F.when(first <= "i", 0).when(first <= "r", 1).otherwise(2).cast("int")


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per token, beside the other columns."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(tokens(text)).alias("word"))
