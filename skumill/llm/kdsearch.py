"""Exact top-k inner-product search with a KD-tree for each shard.

Components become the integers floor(256 x), whatever their size: scores are summed
in doubles where they are exact, else in 64-bit integers, else in integers without
a bound.  Vectors are dealt into shards of about SHARD_ROWS rows, and each shard
becomes a KD-tree: median splits of the widest dimension, a tight box
and the smallest vec_id in every node.  A query walks a tree best first by the
largest inner product that a node's box allows; equal bounds go by the smaller
vec_id, and the walk ends once no node can beat the k-th result.

Queries are first searched in the shard that holds them.  The k-th score that
this gives travels with each block of queries to the other shards, which return
only what beats it.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .neardup import _groups

SHARD_ROWS = 4096
LEAF = 64
#: Blocks of queries that one copy of a tree meets.
FAN = 64
#: Bounds of what a score, and each part of its sum, may reach in doubles and in 64-bit integers.
EXACT = ((2**53, np.float64), (2**62, np.int64))

WIDER = (np.float64, np.int64, object)

Result = list[tuple[int, int]]


def kind_for(most: int) -> type:
    """The narrowest number type that holds every sum up to `most` in size exactly."""
    return next((kind for bound, kind in EXACT if most < bound), object)


def largest(*arrays: np.ndarray) -> int:
    return max((int(abs(x)) for a in arrays if a.size for x in (a.max(), a.min())), default=0)


def as_integers(scaled: np.ndarray) -> np.ndarray:
    """256 times the values, which are whole 256ths: as doubles where those hold the products, else as Python integers."""
    if np.abs(scaled).max(initial=0) < 2.0**990:
        return scaled * 256
    return np.array([[int(x) * 256 if abs(x) > 2.0**60 else int(x * 256) for x in row] for row in scaled.tolist()], dtype=object).reshape(scaled.shape)


def converted(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object or values.dtype == object:
        return values.astype(kind, copy=False)
    return np.array([int(x) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)


class KDTree:
    """Points in the order of their vec_id, and the nodes over them."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.most = largest(points)
        self.kind = kind_for(self.most**2 * max(1, points.shape[1]))
        perm = np.arange(len(ids))
        lo, hi, low_id, spans, kids = [], [], [], [], []
        stack = [(0, len(ids), -1)]
        while stack:
            a, b, parent = stack.pop()
            me, own = len(spans), self.points[perm[a:b]]
            lo.append(own.min(axis=0))
            hi.append(own.max(axis=0))
            low_id.append(int(self.ids[perm[a:b]].min()))
            spans.append((a, b))
            kids.append([])
            if parent >= 0:
                kids[parent].append(me)
            if b - a > leaf:
                axis = int(np.argmax(hi[-1] - lo[-1]))
                perm[a:b] = np.sort(perm[a:b])  # equal coordinates keep the order of the ids
                perm[a:b] = perm[a:b][np.argsort(self.points[perm[a:b], axis], kind="stable")]
                mid = (a + b) // 2
                stack += [(mid, b, me), (a, mid, me)]
        self.ids, self.points = self.ids[perm], converted(self.points[perm], self.kind)
        self.lo, self.hi = converted(np.array(lo, dtype=points.dtype), self.kind), converted(np.array(hi, dtype=points.dtype), self.kind)
        self.low_id, self.spans, self.kids = low_id, spans, kids

    def search(self, query: np.ndarray, own: int, k: int, kth: tuple[int, int] | None = None) -> Result:
        """Up to k pairs (score, vec_id), best first, without the query's own id; with `kth`, only pairs that beat it."""
        size, most = max(1, len(query)), largest(query)
        kind = max(self.kind, kind_for(max(most * self.most, most) * size), key=WIDER.index)
        q, points, lo, hi = (converted(x, kind) for x in (query, self.points, self.lo, self.hi))
        bound = np.maximum(lo * q, hi * q).sum(axis=1).tolist()
        best: list[tuple[int, int]] = []  # heap of (score, -vec_id): the worst on top
        floor = (kth[0], -kth[1]) if kth else None
        queue = [(-bound[0], self.low_id[0], 0)]
        while queue:
            b, low, node = heapq.heappop(queue)
            limit = best[0] if len(best) == k else None
            limit = max(x for x in (limit, floor) if x) if limit or floor else None
            if limit and (-b, -low) <= limit:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(queue, (-bound[kid], self.low_id[kid], kid))
                continue
            start, end = self.spans[node]
            scores = points[start:end] @ q
            if limit:
                some = np.flatnonzero(np.asarray(scores >= limit[0], dtype=bool))
            elif len(scores) > 8 * k and kind is not object:
                some = np.flatnonzero(scores >= np.partition(scores, -k - 1)[-k - 1])
            else:
                some = np.arange(len(scores))
            for s, i in zip(scores[some].tolist(), self.ids[start:end][some].tolist(), strict=True):
                item = (int(s), -i)
                if i == own or (floor and item <= floor):
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def integer_vectors(df: DataFrame, most: int) -> DataFrame:
    """(vec_id, v, copy): floor(256 x) / 256 of each component, a double that holds it exactly; rows that take no part are gone.

    A vector that is null, holds a null or non-finite component or has none at
    all takes no part, nor does a null vec_id.  Of equal rows the first `most` stay,
    numbered from 1: more of them can be in no result.
    """
    x = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("_e")).where("vec_id is not null and _e is not null and size(_e) > 0")
    fine = F.forall("_e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # from 2^45 on, 256 x is whole
    whole = F.transform("_e", lambda c: F.when(F.abs(c) < 2.0**45, F.floor(c * 256).cast("double") / 256).otherwise(c))
    rows = x.where(fine).select("vec_id", whole.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("n"))
    return rows.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(most)).cast("int"))).alias("copy"))


def _rows(result: dict[str, list]) -> pa.RecordBatch:
    """Pairs with their scores; `beyond` is 1 or -1 where no long holds the score, which then is the nearest one."""
    score = result["score"]
    near = [min(max(s, -(2**63)), 2**63 - 1) for s in score]
    cols = [pa.array(result["query_id"], pa.int64()), pa.array(result["vec_id"], pa.int64()), pa.array(near, pa.int64()), pa.array([(s > n) - (s < n) for s, n in zip(score, near, strict=True)], pa.int32())]
    return pa.RecordBatch.from_arrays(cols, ["query_id", "vec_id", "score", "beyond"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query.

    Queries are the vectors whose vec_id is divisible by `every`; candidates are
    all rows with a vector of the same length but those of the query's own id, so
    equal rows fill a rank each; equal rows that ask are one query.  Ties go to
    the smaller vec_id; a query with fewer candidates has fewer rows.  Null vectors,
    empty ones and those with a null or non-finite component take no part; an
    empty table gives an empty result.  Components of any size are searched
    exactly; a returned score that no long holds raises.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, k), "vectors")
    shards = -(-rows.count() // shard_rows) or 1
    many = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select("vec_id", "v", "copy", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartition(many, "dim", "shard").sortWithinPartitions("dim", "shard", "vec_id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["dim", "shard"]):
            dim = t["dim"][0].as_py()
            ids = t["vec_id"].to_numpy()
            points = as_integers(t["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim))
            tree = KDTree(ids, points)
            asked = np.flatnonzero((ids % every == 0) & (t["copy"].to_numpy() == 1))
            home = [tree.search(points[i], int(ids[i]), k) for i in asked.tolist()]
            block = {"ids": ids[asked], "points": points[asked], "kth": [(r[-1] if len(r) == k else None) for r in home]}
            own = [(q, i, s) for q, r in zip(ids[asked].tolist(), home, strict=True) for s, i in r]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), t["shard"].combine_chunks()[:1], pa.array([pickle.dumps(tree)], pa.binary()), pa.array([pickle.dumps(block)], pa.binary()), pa.array([pickle.dumps(own)], pa.binary())],
                ["dim", "shard", "tree", "block", "home"],
            )

    built = stored(dealt.mapInArrow(build, "dim int, shard int, tree binary, block binary, home binary"), "trees")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                q, i, s = zip(*pickle.loads(raw), strict=True) if len(pickle.loads(raw)) else ((), (), ())
                yield _rows({"query_id": list(q), "vec_id": list(i), "score": list(s)})

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for raw, block in zip(batch.column("tree"), batch.column("block"), strict=True):
                if raw.is_valid:  # sorts before the blocks that ask it
                    tree = pickle.loads(raw.as_py())
                    continue
                b = pickle.loads(block.as_py())
                for q, p, kth in zip(b["ids"].tolist(), b["points"], b["kth"], strict=True):
                    for s, i in tree.search(p, q, k, kth):
                        out["query_id"].append(q)
                        out["vec_id"].append(i)
                        out["score"].append(s)
            yield _rows(out)

    groups = -(-shards // FAN)
    trees = built.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("fan"), "tree", F.lit(None).cast("binary").alias("block"))
    asks = built.select("dim", F.col("shard").alias("_home"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block").where("shard <> _home")
    asks = asks.join(built.select("dim", "shard"), ["dim", "shard"], "left_semi").select("dim", "shard", F.floor(F.col("_home") / FAN).cast("int").alias("fan"), F.lit(None).cast("binary").alias("tree"), "block")
    met = trees.unionByName(asks).repartition(many, "dim", "shard", "fan").sortWithinPartitions("dim", "shard", "fan", F.col("tree").isNull())
    kind = "query_id long, vec_id long, score long, beyond int"
    found = met.mapInArrow(visit, kind).unionByName(built.select("home").mapInArrow(unpack, kind))
    best = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    unfit = F.raise_error(F.concat(F.lit("a score of query "), F.col("query_id").cast("string"), F.lit(" does not fit a long")))
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", F.when(F.col("beyond") == 0, F.col("score")).otherwise(unfit.cast("long")).alias("score"))
