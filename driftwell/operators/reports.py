"""Reports over logs of past decisions, and over logs with repeated reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.columns import column_in_message, join_list, quality_status, severity
from driftwell.operators.prefix import global_row_number


def drift_frequency(log: DataFrame, columns: str = "drift_columns") -> DataFrame:
    """How often each column drifted over all runs."""
    return log.select(F.explode(columns).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def top_drift(log: DataFrame, k: int = 5) -> DataFrame:
    return drift_frequency(log).orderBy(F.col("n").desc(), "column").limit(k)


def drift_matrix(log: DataFrame, names: Sequence[str], run: str = "run_id") -> DataFrame:
    """Run x column, 1 where the column drifted."""
    hits = F.col("drift_columns")
    return log.select(run, *[F.coalesce(F.array_contains(hits, c), F.lit(False)).cast("int").alias(c) for c in names])


def drift_matrix_long(log: DataFrame, run: str = "run_id") -> DataFrame:
    """Only the ones of :func:`drift_matrix`; does not need the column names."""
    return log.select(run, F.explode(F.array_distinct("drift_columns")).alias("column")).withColumn("drifted", F.lit(1))


def severity_scorecard(log: DataFrame, k: int = 10, examples: int = 2, cut: int = 60) -> DataFrame:
    """Failures per column with a rating and the first two messages, by time and position.

    Messages that do not name a column in the usual way ("Critical column ...")
    have no column and are left out. Only two messages per column and task are
    carried: the earliest, then the earliest after it.
    """
    items = log.select("timestamp", "run_id", F.posexplode("hard_failures").alias("pos", "message")).withColumn(
        "column", column_in_message("message")
    )
    named = items.where(F.col("column").isNotNull())
    key = F.struct("timestamp", "run_id", "pos", "message")
    first = named.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("e1"))
    top = first.orderBy(F.col("n").desc(), "column").limit(k)
    if examples > 1:
        # at most k rows on the right: the columns kept above
        later = named.join(F.broadcast(top.select("column", "e1")), "column").where(key > F.col("e1"))
        top = top.join(later.groupBy("column").agg(F.min(key).alias("e2")), "column", "left")
    else:
        top = top.withColumn("e2", F.lit(None).cast("struct<message string>"))
    short = lambda e: F.concat(F.substring(F.col(f"{e}.message"), 1, cut), F.lit("..."))
    return top.select("column", "n", severity("n").alias("severity"), short("e1").alias("example_1"), short("e2").alias("example_2"))


def integrity_summary(log: DataFrame) -> DataFrame:
    """Counts of runs by outcome, average issues, quality score and its label."""
    n = F.count(F.lit(1))
    average = F.coalesce(F.try_divide(F.sum(F.col("num_hard_failures") + F.col("num_warnings")), n), F.lit(0.0))
    table = log.agg(
        n.alias("runs"),
        F.count_if("integrity_passed").alias("passed"),
        F.count_if(~F.col("integrity_passed")).alias("failed"),
        F.count_if(F.col("num_warnings") > 0).alias("with_warnings"),
        average.alias("avg_issues"),
        # two maxima added, not the largest sum of one run
        (F.max("num_warnings") + F.max("num_hard_failures")).cast("bigint").alias("max_issues"),
        F.greatest(F.lit(0.0), F.lit(100.0) - average * 5).alias("quality_score"),
    )
    return table.withColumn("status", quality_status("quality_score"))


def anomaly_flags(log: DataFrame, value: str = "num_warnings", sigmas: float = 2.0) -> DataFrame:
    """Rows outside mean +- 2 population deviations; the lower bound is not below 0."""
    stats = log.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s")).first()
    mean, spread = stats["m"] or 0.0, stats["s"] or 0.0
    upper, lower = mean + sigmas * spread, max(0.0, mean - sigmas * spread)
    x = F.col(value)
    return log.withColumns(
        {"upper": F.lit(upper), "lower": F.lit(lower), "anomaly": (x > upper) | (x < lower)}
    )


def flat_log(log: DataFrame) -> DataFrame:
    """Lists as text, for a CSV sink."""
    return log.withColumns(
        {
            "drift_columns": join_list("drift_columns"),
            "hard_failures": join_list("hard_failures", "; "),
            "drift_warnings": join_list("drift_warnings", "; "),
        }
    )


# ---- report log with repeats ------------------------------------------------


def first_per_key(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """First row per key by ``seq``; an aggregate with a partial phase, so hot keys are cheap."""
    return _edge(df, key, seq, F.min_by)


def last_per_key(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    return _edge(df, key, seq, F.max_by)


def _edge(df: DataFrame, key: Sequence[str], seq: str, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    chosen = df.groupBy(*key).agg(pick(F.struct(*rest), F.col(seq)).alias("_row"))
    return chosen.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def attempt_report(log: DataFrame, trial: str = "trial_id", seq: str = "seq", score: str = "score") -> DataFrame:
    """Totals over every attempt: a repeated report counts again in the running mean."""
    per = log.groupBy(trial).agg(
        F.count(F.lit(1)).alias("n"), F.sum(score).alias("s"), F.max_by(score, seq).alias("last")
    )
    return per.agg(
        F.count(F.lit(1)).alias("completed_trials"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("report_attempts"),
        F.sum("s").alias("report_sum"),
        F.try_divide(F.sum("s"), F.sum("n")).alias("running_mean_score"),
        F.avg("last").alias("final_unique_mean_score"),
        F.count_if(F.col("n") > 1).alias("duplicate_trials"),
    )


def idempotent_report(log: DataFrame, trial: str = "trial_id", seq: str = "seq", score: str = "score") -> DataFrame:
    """Totals over the first report of each trial; the result table keeps the last."""
    per = log.groupBy(trial).agg(
        F.count(F.lit(1)).alias("n"), F.min_by(score, seq).alias("first"), F.max_by(score, seq).alias("last")
    )
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("report_attempts"),
        F.count(F.lit(1)).alias("unique_trials"),
        F.avg("first").alias("running_mean_score"),
        F.avg("last").alias("final_unique_mean_score"),
        F.count_if(F.col("n") > 1).alias("duplicate_trials"),
    )


def repeated_keys(log: DataFrame, key: Sequence[str]) -> DataFrame:
    return log.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def completion_rank(df: DataFrame, by: Sequence[str], finished: str, tie: Sequence[str]) -> DataFrame:
    """Rank in arrival order within ``by``; a hot group is cut by time before it is sorted."""
    return global_row_number(df, finished, tie, by=by, out="completion_rank")


def status_label(score: str | Column) -> Column:
    return quality_status(score)
