"""Order-stable deduplication, runs and ordered set operations.

Every operator takes the order explicitly; a table has none of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

#: A table with a key of more rows than about this is cut into parts along its keys and order.
PLAIN_ROWS = 1_000_000
#: Rows sampled for each part to find its bounds.
PER_PART = 32


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`.

    Spark keeps one row a key in each task before it shuffles, so a popular key
    is no single task's work.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_first_row", first).where("_first_row = 1").drop("_first_row")


def first_rows_keep_blank(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key; rows with a null or blank key all stay."""
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    return first_rows(df.where(~blank), [key], order).unionByName(df.where(blank))


def dedupe_report(df: DataFrame, key: str) -> DataFrame:
    """One row (rows, kept, removed) of what `first_rows_keep_blank` does."""
    named = F.when(F.trim(F.col(key).cast("string")) != "", F.col(key))
    per = df.groupBy(named.alias("_k")).agg(F.count("*").alias("n"))
    kept = F.sum(F.when(F.col("_k").isNull(), F.col("n")).otherwise(1))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(kept, F.lit(0)).cast("bigint").alias("kept")).withColumn("removed", F.col("rows") - F.col("kept"))


def _fixed(value, kind: T.DataType) -> Column:
    """A collected value as a constant of its type; timestamps come as microseconds and zoneless ones as text."""
    return F.timestamp_micros(F.lit(value)) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


def _bounds(df: DataFrame, by: Sequence[str], order: Sequence[str], plain_rows: int) -> list[Column]:
    """Tuples of (by, order), in order, that cut the table into parts of about as many rows; none where no key has more than about `plain_rows` rows.

    They come from a random sample of bounded size, taken and counted in one pass.
    Each is a constant of the plan, so a recomputed task deals its rows as before.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns, seen = [*by, *order], Observation()
    kinds = [df.schema[c].dataType for c in columns]
    coded = [F.unix_micros(c) if isinstance(k, T.TimestampType) else F.col(c).cast("string") if isinstance(k, T.TimestampNTZType) else F.col(c) for c, k in zip(columns, kinds, strict=True)]
    named = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], *[c.alias(f"v{i}") for i, c in enumerate(coded)])
    sample = named.observe(seen, F.count(F.lit(1)).alias("rows")).orderBy(F.rand(7)).limit(PER_PART * parts)
    rows = [tuple(r) for r in sample.orderBy(*[f"c{i}" for i in range(len(columns))]).select(*[f"v{i}" for i in range(len(columns))]).collect()]
    largest = max(Counter(r[: len(by)] for r in rows).values(), default=0)
    if not rows or seen.get["rows"] * largest <= plain_rows * len(rows):
        return []
    chosen = dict.fromkeys(rows[len(rows) * k // parts] for k in range(1, parts))
    return [F.struct(*[_fixed(v, k).alias(f"c{i}") for i, (v, k) in enumerate(zip(row, kinds, strict=True))]) for row in chosen]


def in_parts(df: DataFrame, by: Sequence[str], order: Sequence[str], plain_rows: int = PLAIN_ROWS) -> tuple[DataFrame, list[str]]:
    """`df` cut along (by, order) and the columns that say where: none, or `_part` and `_cut`.

    Parts follow each other in the order of the tuple, whatever sortable types it
    has; equal tuples share a part.  `_cut` marks the keys that may go on in another
    part: those of the bounds beside the row's part, two for each part at most.
    """
    limits = _bounds(df, by, order, plain_rows)
    if not limits:
        return df, []
    # a search in two steps: which block of bounds, then which of its bounds
    block = max(1, math.isqrt(len(limits)))
    every, some = F.array(*limits), F.array(*limits[block - 1 :: block])
    place = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([*by, *order])])
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < place))
    part = below(some) * block
    part = part + below(F.slice(every, part + 1, F.lit(block)))
    key = lambda row: F.struct(*[row[f"c{i}"].alias(f"c{i}") for i in range(len(by))])
    beside = [key(F.get(every, F.col("_part") + d)).eqNullSafe(key(place)) for d in (-1, 0)] if by else [F.lit(True)]
    inside = [F.col("_part") + d for d in (-1, 0)]
    cut = reduce(lambda a, b: a | b, [x & (i >= 0) & (i < len(limits)) for x, i in zip(beside, inside)])
    # a generator binds the part: the optimiser would repeat the search wherever the part is used
    return df.select("*", F.explode(F.array(part)).alias("_part")).withColumn("_cut", cut), ["_part", "_cut"]


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A null-safe join on keys that both sides have; the right side's keys go."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in b.columns])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return a.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def _upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _coded(df: DataFrame, by: Sequence[str], order: Sequence[str], code: Column, plain_rows: int) -> tuple[DataFrame, list[str], list[str]]:
    """Rows in parts with `_piece`, the number of code changes before each row of its part; the keys of a part, and the row order."""
    rows, cut = in_parts(df, by, order, plain_rows)
    own, line = [*by, *cut[:1]], [*order, "__code"]
    w = Window.partitionBy(*own).orderBy(*line)
    rows = rows.withColumn("__code", F.struct(code.alias("c")))
    changed = F.when(F.row_number().over(w) == 1, 0).when(F.col("__code").eqNullSafe(F.lag("__code").over(w)), 0).otherwise(1)
    rows = rows.withColumn("_changed", changed)
    return rows.withColumn("_piece", F.sum("_changed").over(_upto(w))), own, line


def with_runs(df: DataFrame, by: Sequence[str], order: Sequence[str], code: Column, run: str = "run", plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """A number for each run of equal neighbouring codes within `by`, from 1; nulls are equal.

    The order columns may be of any sortable types; rows that are equal in all of
    them follow each other by code.  A table with a key of more than about
    `plain_rows` rows is cut along its keys and order, so that such a key is shared
    by many tasks; what crosses a part's bounds comes from a table of two rows a
    part.  The numbers are the same either way.
    """
    rows, own, line = _coded(df, by, order, code, plain_rows)
    if len(own) == len(by):
        return rows.withColumn(run, F.col("_piece") + 1).drop("__code", "_changed", "_piece")
    place, over = F.struct(*line), Window.partitionBy(*by).orderBy("_part")
    edges = rows.where("_cut").groupBy(*own).agg(F.min_by("__code", place).alias("_first"), F.max_by("__code", place).alias("_last"), F.max("_piece").alias("_n"))
    edges = edges.withColumn("_new", F.when(F.col("_first").eqNullSafe(F.lag("_last").over(over)), 0).otherwise(1))
    edges = edges.withColumn("_start", F.sum(F.col("_n") + F.col("_new")).over(_upto(over)) - F.col("_n"))
    joined = _same(rows, F.broadcast(edges.select(*own, "_start")), own)
    return joined.withColumn(run, F.col("_piece") + F.coalesce("_start", F.lit(1))).drop("__code", "_changed", "_piece", "_start", "_part", "_cut")


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], code: Column, value: Column, out: str = "carried", plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """The value of the first row of each run of equal codes, on every row of the run; a run whose first value is null stays null.

    Rows that are equal in all order columns follow each other by code, then by value.
    """
    rows, own, line = _coded(df.withColumn("_v", F.struct(value.alias("v"))), by, order, code, plain_rows)
    line = [*line, "_v"]
    rows = rows.withColumn("_own", F.first("_v").over(Window.partitionBy(*own, "_piece").orderBy(*line)))
    made = ["__code", "_changed", "_piece", "_v", "_own"]
    if len(own) == len(by):
        return rows.withColumn(out, F.col("_own")["v"]).drop(*made)
    place, over = F.struct(*line), Window.partitionBy(*by).orderBy("_part")
    edges = rows.where("_cut").groupBy(*own).agg(F.min_by("__code", place).alias("_first"), F.max_by("__code", place).alias("_last"), F.max_by("_own", place).alias("_tail"), F.max("_piece").alias("_n"))
    edges = edges.withColumn("_goes_on", F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(over)), F.lit(False)))
    # the run that a part leaves open began in the last part that began one
    began = F.last(F.when(~F.col("_goes_on") | (F.col("_n") > 0), F.col("_tail")), ignorenulls=True)
    edges = edges.withColumn("_head", F.when(F.col("_goes_on"), began.over(over.rowsBetween(Window.unboundedPreceding, -1))))
    joined = _same(rows, F.broadcast(edges.select(*own, "_head")), own)
    return joined.withColumn(out, F.coalesce(F.when(F.col("_piece") == 0, F.col("_head")), F.col("_own"))["v"]).drop(*made, "_head", "_part", "_cut")


def failure_streaks(df: DataFrame, by: Sequence[str], order: Sequence[str], failed: Column, out: str = "streak", plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """How many failures in a row end at each row; a success sets it to 0.

    Of rows that are equal in all order columns the successes come first.  Large
    tables are cut into parts as in `with_runs`.
    """
    rows, cut = in_parts(df.withColumn("_bad", F.coalesce(failed, F.lit(False)).cast("int")), by, order, plain_rows)
    own, line = [*by, *cut[:1]], [*order, "_bad"]
    rows = rows.withColumn("_block", F.sum(1 - F.col("_bad")).over(_upto(Window.partitionBy(*own).orderBy(*line))))
    rows = rows.withColumn("_s", F.sum("_bad").over(_upto(Window.partitionBy(*own, "_block").orderBy(*line))))
    if not cut:
        return rows.withColumn(out, F.when(F.col("_bad") == 1, F.col("_s")).otherwise(0).cast("bigint")).drop("_bad", "_block", "_s")
    over = Window.partitionBy(*by).orderBy("_part")
    edges = rows.where("_cut").groupBy(*own).agg(F.count("*").alias("_n"), F.sum("_bad").alias("_f"), F.max_by(F.col("_s") * F.col("_bad"), F.struct(*line)).alias("_tail"))
    edges = edges.withColumn("_island", F.sum(F.when(F.col("_n") == F.col("_f"), 0).otherwise(1)).over(_upto(over)))
    # a part's carry: the tails since the last part with a success, up to the part before
    edges = edges.withColumn("_sum", F.sum("_tail").over(_upto(Window.partitionBy(*by, "_island").orderBy("_part")))).withColumn("_carry", F.coalesce(F.lag("_sum").over(over), F.lit(0)))
    joined = _same(rows, F.broadcast(edges.select(*own, "_carry")), own)
    streak = F.when(F.col("_bad") == 0, 0).when(F.col("_block") == 0, F.col("_s") + F.coalesce("_carry", F.lit(0))).otherwise(F.col("_s"))
    return joined.withColumn(out, streak.cast("bigint")).drop("_bad", "_block", "_s", "_carry", "_part", "_cut")


def streak_alerts(df: DataFrame, streak: str = "streak", every: int = 6, abort: int = 18) -> DataFrame:
    """Rows at which a streak calls for a pause (each `every`-th failure) or for an end (from `abort` on)."""
    s = F.col(streak)
    return df.withColumn("alert", F.when(s >= abort, "abort").when((s > 0) & (s % every == 0), "pause")).where("alert is not null")


def union_first(parts: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The union of tables; a key's row comes from the earliest table, then by `order`."""
    numbered = reduce(DataFrame.unionByName, [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)])
    return first_rows(numbered, keys, ["_part", *order]).drop("_part")


def ordered_union(*lists: Column) -> Column:
    """The distinct elements of arrays in order of first appearance; a null array counts as empty."""
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])))


def pending(wanted: DataFrame, done: DataFrame, failed: DataFrame | None, key: str, retry_failed: bool = False) -> DataFrame:
    """What is wanted and not done; what failed comes back only on request."""
    left = wanted.join(done.select(key), key, "left_anti")
    return left if failed is None or retry_failed else left.join(failed.select(key), key, "left_anti")


def reuse(wanted: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    """Finished results of what is wanted, in the wanted order."""
    return wanted.join(done, key).orderBy(order)


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order`."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), _order(order)).alias("_r")).select("_r.*")


def source_order(df: DataFrame, key: str, pos: str) -> DataFrame:
    """Groups by their first appearance, rows by position inside."""
    first = df.groupBy(key).agg(F.min(pos).alias("_first"))
    return df.join(first.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).orderBy("_first", pos).drop("_first", "_key")


def batch_ids(df: DataFrame, order: str | Sequence[str], size: int = 60, out: str = "batch_id", plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """A batch number for each row, `size` rows a batch, in the order of one or several columns of any sortable types.

    The rank of a row is its rank within a range of the order plus the rows of
    the ranges before, so no task sorts a large table.  Which of two rows that are
    equal in all order columns comes first is open.
    """
    line = [order] if isinstance(order, str) else list(order)
    marked, cut = in_parts(df, [], line, plain_rows)
    rank = F.row_number().over(Window.partitionBy(*(cut[:1] or [F.lit(0)])).orderBy(*line))
    if not cut:
        return marked.withColumn(out, F.floor((rank - 1) / size))
    counts = marked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # one row for each range at most
    return marked.withColumn("_rank", rank).join(F.broadcast(before), "_part").withColumn(out, F.floor((F.col("_before") + F.col("_rank") - 1) / size)).drop("_part", "_cut", "_rank", "_before")


def grouped(df: DataFrame, key: str, order: Sequence[str], rows: str = "rows") -> DataFrame:
    """(key, rows): each key's rows as an array in order, keys in upper case and null as ''.

    For groups that are small by nature, such as the variants of one model.
    """
    name = F.upper(F.coalesce(F.col(key).cast("string"), F.lit("")))
    ordered = F.sort_array(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order])))
    return df.groupBy(name.alias(key)).agg(ordered.alias(rows))


def first_n(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first n rows by `order`, all of them for None."""
    return df if n is None else df.orderBy(*order).limit(n)
