"""Readers: seed lists, headed and headerless tables, logs, listings, pages.

Each gives rows an explicit position, since results depend on source order: files
in the order of their paths, rows in the order of their file, numbered from 0.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import schemas as S
from ..functions.html import valid_text
from ..functions.text import trimmed
from ..functions.urls import canonical_product
from ..operators.dedupe import first_rows


def _positioned(df: DataFrame, line: str | None = None) -> DataFrame:
    """`df` with pos, the row's number over all of its files, and on request its number within its file.

    Spark packs the pieces of files into tasks by size, so a row's place comes from
    its file, the start of its piece and its rank within it; a table with one row
    for each piece tells how many rows come before.  A table that is not read
    from files keeps the order that Spark has it in.
    """
    try:
        raw = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_row"))
    except AnalysisException:
        if line:
            raise
        return df.withColumn("pos", F.monotonically_increasing_id())
    pieces = raw.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")
    every, own = Window.orderBy("_file", "_start"), Window.partitionBy("_file").orderBy("_start")
    pieces = pieces.select(F.col("_file").alias("_f"), F.col("_start").alias("_s"), before(every).alias("_before"), before(own).alias("_inside"))
    placed = raw.join(pieces, (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
    added = [(F.col("_row") + F.col("_before")).alias("pos"), *([(F.col("_row") + F.col("_inside")).alias(line)] if line else [])]
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *added)


def seed_list(spark: SparkSession, path: str, default: list[str] | None = None) -> DataFrame:
    """(pos, seed_url): lines that are not blank and no comment, without a byte order mark.

    An empty list raises, or gives `default`.
    """
    lines = _positioned(spark.read.text(path)).select("pos", trimmed(F.regexp_replace("value", "^\\x{FEFF}", "")).alias("seed_url"))
    lines = lines.where("seed_url <> '' and seed_url not like '#%'")
    if lines.isEmpty():
        if default is None:
            raise ValueError(f"{path} holds no seed")
        return spark.createDataFrame(list(enumerate(default)), "pos long, seed_url string")
    return lines


def sku_table(df: DataFrame, column: str = "sku") -> DataFrame:
    """(pos, sku): the column of that name in any case, without null and blank values."""
    found = [c for c in df.columns if c.strip().lower() == column]
    if not found:
        raise ValueError(f"no column {column} in {df.columns}")
    return _positioned(df).select("pos", F.trim(F.col(f"`{found[0]}`").cast("string")).alias("sku")).where("sku <> ''")


def positional_table(spark: SparkSession, path: str, names: list[str], skip: int, schema: T.StructType | None = None) -> DataFrame:
    """A headerless CSV by column position, without the first `skip` rows of each file; the columns of `schema` are cast."""
    raw = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path, header=False, multiLine=False, enforceSchema=True)
    rows = _positioned(raw, "_line").where(F.col("_line") >= skip)
    kinds = {f.name: f.dataType for f in (schema.fields if schema else [])}
    return rows.select("pos", *[F.col(n).try_cast(kinds[n]).alias(n) if n in kinds else F.col(n) for n in names])


def supply_table(spark: SparkSession, path: str) -> DataFrame:
    return positional_table(spark, path, S.SUPPLY_POSITIONS[:7], 1, S.SUPPLY)


def listing_table(spark: SparkSession, path: str) -> DataFrame:
    return positional_table(spark, path, S.LISTING_POSITIONS[:39], 3, S.LISTING)


def product_urls(sheet: DataFrame, base: str) -> DataFrame:
    """(pos, url): every cell that holds a product URL, canonical, first of each."""
    cells = _positioned(sheet).select("pos", F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in sheet.columns])).alias("cell", "value"))
    urls = cells.where(F.col("value").contains("/product/")).select("pos", "cell", canonical_product(F.trim("value"), base).alias("url"))
    return first_rows(urls, ["url"], ["pos", "cell"]).select("pos", "url")


def file_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, name, size, modified) of the files that a pattern matches; their contents are not opened."""
    found = spark.read.format("binaryFile").load(pattern)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def newest(spark: SparkSession, pattern: str, reader: str = "csv", smallest: bool = False, preferred: str | None = None, **options) -> DataFrame:
    """The rows of the file with the greatest (or smallest) name among those a pattern matches; `preferred` comes first if it is there.

    Names come from a listing, so only the chosen file is opened.  Of files of one
    name in several folders the greatest path counts.  A pattern that matches no
    file raises.
    """
    rank = F.struct((F.col("name") == F.lit(preferred)).cast("int") if preferred else F.lit(0), "name", "path")
    low = F.struct((F.col("name") != F.lit(preferred)).cast("int") if preferred else F.lit(0), "name", "path")
    chosen = file_listing(spark, pattern).agg(F.min_by("path", low) if smallest else F.max_by("path", rank)).first()[0]
    if chosen is None:
        raise FileNotFoundError(pattern)
    return spark.read.format(reader).options(**options).load(chosen)


def headed_lines(spark: SparkSession, path: str, header: str = "brand\t") -> DataFrame:
    """(pos, value) of a tab-separated text, without the first line of a file if that is a header."""
    lines = _positioned(spark.read.text(path), "_line")
    return lines.where(~((F.col("_line") == 0) & F.ltrim("value").startswith(header))).select("pos", "value")


def work_log(spark: SparkSession, path: str, schema: str = "url string, rows array<string>") -> DataFrame:
    """Completed work from JSON lines: corrupt lines are dropped and the last line of a url counts, by run and by place in its run.

    `append_log` stamps the run; lines without a stamp come before all runs, in
    the order of their files.
    """
    log = _positioned(spark.read.schema(f"{schema}, _run bigint, _place bigint").json(path, mode="DROPMALFORMED")).where("url is not null")
    made = ("url", "pos", "_run", "_place")
    order = F.struct(F.coalesce("_run", F.lit(-1)), F.coalesce("_place", F.lit(-1)), "pos")
    return log.groupBy("url").agg(F.max_by(F.struct(*[c for c in log.columns if c not in made]), order).alias("_r")).select("url", "_r.*")


def pages(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good (url, status, html), failures (url, error)) of fetched bodies (url, status, body as bytes or text)."""
    text = df.select("url", "status", valid_text(F.col("body")).alias("html"))
    error = F.when(F.coalesce(F.col("status"), F.lit(0)) >= 400, F.concat(F.lit("HTTP "), F.col("status").cast("string"))).when(F.coalesce(F.length("html"), F.lit(0)) == 0, "empty body")
    marked = text.withColumn("error", error)
    return marked.where("error is null").drop("error"), marked.where("error is not null").select("url", "error")
