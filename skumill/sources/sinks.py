"""Writers: declared column orders, failure tables, run-stamped and snapshot outputs."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas as S
from ..operators.dedupe import latest

COMMIT = "run_brand string, run_ts string"
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; a temporary one only in local mode where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the cluster shares")
        root = "file://" + tempfile.mkdtemp(prefix="skumill-")
    return noted(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")


def noted(path: str) -> str:
    """`path`, to be deleted at the end of the `scratch` block that is open, if one is."""
    if (own := _NOTED.get()) is not None:
        own.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block at whose end the tables go that operators have written for themselves within it.

    Results that read them have to be written or collected before it ends.
    """
    own: list[str] = []
    before = _NOTED.set(own)
    try:
        yield
    finally:
        _NOTED.reset(before)
        for path in own:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage ends here and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns in their order, missing ones and nulls as ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def write_rows(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    in_order(df, columns).write.mode(mode).parquet(path)


def write_failures(failed: DataFrame, path: str) -> bool:
    """A failure table, only where there are failures."""
    if failed.isEmpty():
        return False
    failed.select("url", "error").write.mode("overwrite").parquet(path)
    return True


def reconciled(df: DataFrame, positions: Sequence[str]) -> DataFrame:
    """A reconciled table in its column order; offer, SKU and barcode numbers stay text."""
    text = {"offer_id", "sku_id", "barcode"}
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.select(*[own(c).cast("string").alias(c) if c in text else own(c).alias(c) for c in positions])


def listing_output(df: DataFrame) -> DataFrame:
    return reconciled(df, S.LISTING_POSITIONS)


def supply_output(df: DataFrame) -> DataFrame:
    return reconciled(df, S.SUPPLY_POSITIONS)


def write_run(df: DataFrame, path: str, run_ts: str, brand: str) -> None:
    """Publish a brand's run under its stamp: a run that is written again is replaced, nothing else is touched.

    The run counts from the moment its commit stands beside the table, in
    `<path>.commits`; a job that ends before leaves files that `current_runs` passes over.
    """
    stamped = df.withColumn("run_ts", F.lit(run_ts)).withColumn("run_brand", F.lit(brand))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_brand", "run_ts").parquet(path)
    commit_run(df.sparkSession, path, run_ts, brand)


def commit_run(spark: SparkSession, path: str, run_ts: str, brand: str) -> None:
    spark.createDataFrame([(brand, run_ts)], COMMIT).coalesce(1).write.mode("append").json(f"{path}.commits")


def _newest_commits(spark: SparkSession, path: str, keep: int = 1) -> list[tuple[str, str]]:
    """(brand, stamp) of the `keep` newest committed runs of each brand; a brand has one row for each run it ever committed."""
    commits = spark.read.schema(COMMIT).json(f"{path}.commits").distinct()
    place = F.row_number().over(Window.partitionBy("run_brand").orderBy(F.desc("run_ts")))
    return [tuple(r) for r in commits.withColumn("_place", place).where(F.col("_place") <= keep).drop("_place").collect()]


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed run of each brand; no other run's folder is read."""
    runs = _newest_commits(spark, path)
    table = spark.read.option("basePath", path).parquet(path)
    named = [(F.col("run_brand") == F.lit(brand)) & (F.col("run_ts").cast("string") == F.lit(stamp)) for brand, stamp in runs]
    return table.where(reduce(lambda a, b: a | b, named, F.lit(False)))


def drop_old_runs(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the runs that are not among the `keep` newest committed ones of their brand; how many folders went."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    kept = {f"run_brand={escape(brand)}/run_ts={escape(stamp)}" for brand, stamp in _newest_commits(spark, path, keep)}
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in fs.globStatus(at(f"{path}/run_brand=*/run_ts=*")) if f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" not in kept]
    for folder in old:
        fs.delete(folder, True)
    return len(old)


def latest_run(df: DataFrame, stamp: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """The rows of the newest stamp, overall or by other columns."""
    top = df.groupBy(*by).agg(F.max(stamp).alias(stamp)) if by else df.agg(F.max(stamp).alias(stamp))
    return df.join(top, [*by, stamp], "left_semi")


def write_lines(df: DataFrame, path: str, columns: Sequence[str], header: str | None = None) -> None:
    """Tab-separated lines; nulls are blank fields."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    if header:
        df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1).write.mode("append").text(path)


def write_export(df: DataFrame, path: str, **options) -> None:
    """One CSV file under a name of its own, as people exchange them; for results that one task can write."""
    spark, part = df.sparkSession, f"{path}-{uuid.uuid4().hex[:8]}"
    df.coalesce(1).write.options(**options).csv(part)
    to = spark._jvm.org.apache.hadoop.fs.Path
    fs = to(path).getFileSystem(spark._jsc.hadoopConfiguration())
    made = [f.getPath() for f in fs.listStatus(to(part)) if f.getPath().getName().startswith("part-")]
    fs.delete(to(path), False)
    if not made or not fs.rename(made[0], to(path)):
        raise OSError(f"{path} was not written")
    fs.delete(to(part), True)


def append_log(df: DataFrame, path: str, order: str | None = None, run: int | None = None) -> None:
    """Append JSON lines under a run's stamp (the time in microseconds by default); `order` names a column that orders them."""
    stamp = time.time_ns() // 1000 if run is None else run
    place = F.col(order).cast("bigint") if order else F.monotonically_increasing_id()
    df.select("*", F.lit(stamp).cast("bigint").alias("_run"), place.alias("_place")).write.mode("append").json(path)


def append_errors(df: DataFrame, path: str, run_ts: str) -> None:
    """(time, url, error, elapsed) rows of failed items."""
    cols = [F.lit(run_ts).alias("time"), "url", "error", (F.col("elapsed") if "elapsed" in df.columns else F.lit(None)).cast("double").alias("elapsed")]
    df.select(*cols).write.mode("append").parquet(path)


def drop_finished(spark, path: str, complete: bool) -> bool:
    """Delete a job's work state once the job is complete."""
    if complete:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return complete


def cache_output(cache: DataFrame) -> DataFrame:
    return latest(cache, "source", ["target"]).select("source", "target")
