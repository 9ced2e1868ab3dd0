"""Run metrics: completeness, outcomes, failure reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness(wanted: DataFrame, done: DataFrame, failed_seeds: DataFrame, key: str) -> DataFrame:
    """One row (total, remaining, failed_seeds, complete): complete means some work, none left and no failed seed."""
    state = wanted.select(key).distinct().join(done.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    counts = state.agg(F.count("*").alias("total"), F.count_if(F.col("_done").isNull()).alias("remaining"))
    failed = failed_seeds.agg(F.count("*").alias("failed_seeds"))
    return counts.crossJoin(failed).withColumn("complete", (F.col("total") > 0) & (F.col("remaining") == 0) & (F.col("failed_seeds") == 0))


def counts_by(df: DataFrame, what: str, name: str = "n") -> DataFrame:
    """Rows by outcome or reason."""
    return df.groupBy(what).agg(F.count("*").alias(name))


def filled(column: str) -> Column:
    """How many rows have a value that is not blank."""
    return F.count_if(F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) != "")


def run_summary(found: DataFrame, done: DataFrame, rows: DataFrame, removed: int | Column, failed_seeds: DataFrame, key: str, sku: str = "sku") -> DataFrame:
    """One row of a run_metrics table: found, done, rows, with_sku, removed, failed_seeds."""
    one = found.agg(F.countDistinct(key).alias("found"))
    for df in (done.agg(F.countDistinct(key).alias("done")), rows.agg(F.count("*").alias("rows"), filled(sku).alias("with_sku")), failed_seeds.agg(F.count("*").alias("failed_seeds"))):
        one = one.crossJoin(df)  # one row each
    return one.withColumn("removed", removed if isinstance(removed, Column) else F.lit(removed))


def with_timings(summary: DataFrame, seconds: dict[str, float]) -> DataFrame:
    """Stage times as columns, with their total."""
    for name, s in seconds.items():
        summary = summary.withColumn(f"{name}_s", F.lit(float(s)))
    return summary.withColumn("total_s", F.lit(float(sum(seconds.values()))))


def total_size(listing: DataFrame) -> DataFrame:
    """The bytes of all listed objects."""
    return listing.agg(F.coalesce(F.sum("fsize"), F.lit(0)).alias("total_size"))
