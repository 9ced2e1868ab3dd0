"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row descends from the root: at every level each child draws -ln(u) / weight,
where u in (0, 1) is a hash of the row's key and the child's name and the weight
is the sum of the shard weights below the child; the smallest draw wins.  A child
wins with a probability in proportion to its weight, and a change of weights moves
rows only between subtrees whose weights differ: all other draws stay as they are.

The law is `key`: doc_id and the shard count decide.  Shards over the base tree
join it as regions of their own, so one more shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS, BASE = 40, 40
RACKS_PER_REGION, SHARDS_PER_RACK = 4, 5
#: Bytes counted for a row besides its text.
ROW_BYTES = 16

Tree = list[tuple[int, int, int, float]]


def tree_of(shards: int, base: int = BASE) -> Tree:
    """(region, rack, shard, weight) of each of `shards` shards of weight 1.

    The first `base` fill racks of SHARDS_PER_RACK and regions of RACKS_PER_REGION
    racks; each further one is a region of its own.
    """
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    regions = -(-base // per_region)
    return [(s // per_region, s // SHARDS_PER_RACK, s, 1.0) if s < base else (regions + s - base, base + s, s, 1.0) for s in range(shards)]


def _draw(key: Column, level: int, children: Column) -> Column:
    """The id of the child (struct id, w) with the smallest draw; equal draws go to the smaller id."""

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child["id"]), 11)
        return F.struct((-F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / child["w"]).alias("t"), child["id"].alias("id"))

    return F.array_min(F.transform(children, draw))["id"]


def _children(of: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(i).cast("int").alias("id"), F.lit(float(w)).alias("w")) for i, w in sorted(of.items()) if w > 0])


#: Equal rows that one step numbers.
RUN = 1 << 14


def place(key: Column, tree: Tree) -> Column:
    """The shard of a key; a subtree without weight takes nothing."""
    if not any(w > 0 for *_, w in tree):
        raise ValueError("the tree has no weight")
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    shards: dict[int, dict[int, float]] = {}
    for region, rack, shard, w in tree:
        regions[region] = regions.get(region, 0) + w
        racks.setdefault(region, {})
        racks[region][rack] = racks[region].get(rack, 0) + w
        shards.setdefault(rack, {})[shard] = w
    level = lambda below: F.create_map(*[x for k, own in below.items() if any(own.values()) for x in (F.lit(k), _children(own))])
    region = _draw(key, 1, _children(regions))
    rack = _draw(key, 2, level(racks)[region])
    return _draw(key, 3, level(shards)[rack])


def with_shards(docs: DataFrame, tree: Tree, shard: str = "__shard") -> DataFrame:
    """`docs` with the shard of each row's doc_id; rows without an id share one."""
    return docs.withColumn(shard, place(F.col("doc_id").cast("long"), tree))


def shard_table(docs: DataFrame, shards: int = SHARDS, base: int = BASE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of `docs`.

    size is the text's UTF-8 bytes (a null text: none) plus 16 and text_crc32 that
    of these bytes.  slot numbers the rows of a shard from 0 without gaps, by a
    hash of its doc_id and text's size and sum, then these; equal rows are counted
    before the shuffle and get neighbouring slots.  Neither the texts of one doc_id
    nor the rows without any meet in one task.  grown_shard is the shard with one shard more.  An empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("doc_id").cast("long")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("string").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_n"))
    bucket = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("int")
    counted = counted.withColumn("shard", place(key, tree_of(shards, base))).withColumn("grown_shard", place(key, tree_of(shards + 1, base))).withColumn("_b", bucket)
    totals = counted.groupBy("shard", "_b").agg(F.sum("_n").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("shard", "_b", before.alias("_start"))
    own = F.coalesce(F.sum("_n").over(Window.partitionBy("shard", "_b").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most shards x buckets rows
    placed = counted.withColumn("_own", own).join(F.broadcast(starts), ["shard", "_b"])
    # two steps, so that no array grows with the number of equal rows
    placed = placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN))))
    placed = placed.withColumn("_i", F.explode(F.sequence(F.col("_k") * RUN, F.least(F.col("_n"), (F.col("_k") + 1) * RUN) - 1)))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_start") + F.col("_own") + F.col("_i")).cast("long").alias("slot"), "grown_shard")
