"""Query of the SentencePiece encoder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from driftwell.llm.catalog import query
from driftwell.llm.pieces import encode_pieces
from driftwell.plans.catalog import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def digests(encoded):
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.concat_ws(",", F.col("ids").cast("array<string>")), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op11_piece_table")
def piece_table(spark, sf_dir):
    return digests(encode_pieces(table(spark, sf_dir, "documents"), MODEL))
