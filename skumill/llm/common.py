"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with one key are dealt to this many tasks by `spread_join`.
SALTS = 8

#: Largest bitmap of `with_maybe_in`: 64 MB.
MAP_BITS = 1 << 29

#: Largest driver-built value that is sent to every executor, in bytes.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only in local mode where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("skumill.work.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the cluster shares")
        root = "file://" + tempfile.mkdtemp(prefix="skumill-")
        spark.conf.set("skumill.work.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def refuse_clashes(df: DataFrame, *names: str) -> None:
    """Raise where `df` already has a column that an operator is about to add."""
    taken = {c.lower() for c in df.columns}
    if clash := [n for n in names if n.lower() in taken]:
        raise ValueError(f"the table already has {', '.join(clash)}; choose other names")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends here and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files that `stored` wrote for `df`; nothing may read it afterwards."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread_join(many: DataFrame, one: DataFrame, on: str, spread_by: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join `many` to `one` (a row per key at most), where one key may hold most rows of `many`.

    A key's rows are dealt over `salts` tasks by `spread_by`, and adaptive
    execution can split what is still large, as both sides have a shuffle of
    their own.  The rows of `one` are repeated for each salt, so they should be
    narrow; Spark's size estimate does not know of the repetition, so the join is
    never left to a broadcast.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [on, "_salt"], how).drop("_salt")


def with_maybe_in(df: DataFrame, members: DataFrame, on: list[str], name: str) -> DataFrame:
    """`df` with a column `name`: true for every row whose key is in `members`, and for a few others.

    A bitmap of the keys' hashes, MAP_BITS at most, goes to every executor, so that
    only rows that may match have to be shuffled for an exact join.  Too many keys
    only make it say true more often.  Rows with a null in their key get false.
    """
    bits = min(MAP_BITS, 1 << max(15, (16 * members.count()).bit_length()))
    place = lambda d: F.pmod(F.xxhash64(*[d[c] for c in on]), F.lit(bits)) + 1
    bucket, held, at = (free_name(df, n) for n in ("_bucket", "_bits", "_at"))
    # one row for each 32 768 bits: 16 384 rows of 4 KB at most
    maps = members.select(place(members).alias("p")).groupBy(F.bitmap_bucket_number("p").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias(held))
    known = reduce(lambda a, b: a & b, [df[c].isNotNull() for c in on])
    placed = df.withColumn(at, F.when(known, place(df)))
    joined = placed.join(F.broadcast(maps), F.bitmap_bucket_number(placed[at]) == maps[bucket], "left")
    bit = F.bitmap_bit_position(F.col(at))
    byte = F.conv(F.hex(F.substr(F.col(held), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return joined.select(*[placed[c] for c in df.columns], F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False)).alias(name))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of `edges` (u, v); the component is its smallest node.

    Alternates large-star and small-star steps, each a pre-aggregated minimum
    and a salted join, so that a hub's edges never meet in one task.  Every
    round is written to the shared folder.
    """

    def minimum(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = minimum(both).select("u", F.least("u", "m").alias("m"))
        large = spread_join(both, low, "u", F.col("v")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large")
        low = minimum(large)
        small = spread_join(large, low, "u", F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        then = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        seen = then.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        discard(large)
        discard(now)
        now = then
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
