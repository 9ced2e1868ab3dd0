"""Ranked lexical search by term-at-a-time sums over short lists, then document-at-a-time over long ones.

`build_index` writes an inverted index in shards of about `shard_bytes` of text: a
shard is one row, with its documents in the order of their ids, their lengths, the
sorted term hashes and a list of (document, occurrences) for each term.  Shards are
cut as tasks read the documents, so the index is built without a shuffle.

`search` ranks all documents for a set of queries.  The collection's figures come
from the shards' small columns; every shard is then searched for every query:

1. Lists of the query's terms that are short beside the shard are summed term at a
   time.  What they add up to is one more list, sorted by document, with bounds.
2. That list and the long ones are walked document at a time in ranges of
   documents.  Each has a bound for the whole shard and one for each range.  Lists
   whose bounds together cannot reach the k-th score so far offer no candidates:
   they are only looked up for documents that others offer, and only while the
   document can still get there.  A range whose bounds cannot reach it is skipped.

The k-th scores are carried from shard to shard within a task.  Bounds are compared
so that a tie is never skipped: results are exact.

Terms are compared by a 64-bit hash; among a million distinct terms of a collection
and a thousand of the queries, two share one with a chance of 5e-11.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_BYTES, fresh_path, stored
from .textscan import LOWER, WORD, column_bytes, row_of, slices, span_hashes, word_spans

TOP = 20
#: Text of one shard; a longer document is a shard by itself.
SHARD_BYTES = 8 << 20
#: A list is short if it holds at most one of so many documents of its shard.
SHORT = 16
#: Documents of a range with bounds of its own.
RANGE = 1024
#: Bytes for each term of a query, as sent: its hash, weight, count and the query's own row.
TERM_BYTES = 64
#: Name of a null doc_id inside a shard: it comes after all others.
NO_ID = np.iinfo(np.int64).max

SHARD = "shard long, n_docs long, n_terms long, ids binary, null_ids binary, lengths binary, terms array<long>, df array<int>, docs binary, tfs binary"


def term_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of every row, and the n + 1 bounds of the rows."""
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, WORD)
    return span_hashes(low, starts, ends).view(np.int64), bounds


def _counted(rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, row) pairs in that order, and how often each occurs."""
    order = np.lexsort((rows, terms))
    rows, terms = rows[order], terms[order]
    new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])])) if len(rows) else np.zeros(0, np.int64)
    return rows[new], terms[new], np.diff([*new.tolist(), len(rows)])


@dataclass
class _Open:
    """A shard that is being filled."""

    ids: list
    lengths: list
    parts: list
    size: int = 0
    rows: int = 0

    def add(self, ids: list, buf: np.ndarray, offs: np.ndarray) -> None:
        h, bounds = term_hashes(buf, offs)
        rows, terms, tf = _counted(row_of(bounds), h)
        self.parts.append((rows + self.rows, terms, tf))
        self.ids += ids
        self.lengths.append(np.diff(bounds))
        self.size += len(buf)
        self.rows += len(ids)

    def closed(self, number: int) -> dict:
        lengths = np.concatenate(self.lengths)
        keep = np.flatnonzero(lengths)
        null = np.array([i is None for i in self.ids], dtype=bool)
        ids = np.array([NO_ID if i is None else i for i in self.ids], dtype=np.int64)
        order = keep[np.lexsort((ids[keep], null[keep]))]  # documents without terms take no part
        place = np.full(len(ids), -1, dtype=np.int64)
        place[order] = np.arange(len(order))
        rows, terms, tf = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        rows = place[rows]
        by = np.lexsort((rows, terms))
        own, df = np.unique(terms[by], return_counts=True)
        return {
            "shard": number, "n_docs": len(order), "n_terms": int(lengths.sum()), "ids": ids[order].tobytes(), "null_ids": null[order].tobytes(), "lengths": lengths[order].astype(np.int64).tobytes(),
            "terms": own, "df": df.astype(np.int32), "docs": rows[by].astype(np.int32).tobytes(), "tfs": tf[by].astype(np.int32).tobytes(),
        }


def _shard_batch(shard: dict) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(shard.values(), kinds, strict=True)], list(shard))


def build_index(docs: DataFrame, path: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the inverted index of `docs` (doc_id, text) to `path` (by default in the shared folder) and return it.

    Terms are runs of ASCII letters and digits and of non-ASCII characters, with
    A-Z read as a-z.  Documents without terms (null or empty texts too) are not in
    it.  Repeated rows and the texts of a repeated doc_id are documents of their
    own; a null doc_id stays null.  Other columns are ignored; an empty table gives
    an empty index.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, now = TaskContext.get().partitionId() << 32, _Open([], [], [])
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            for i, j in slices(offs, min(1 << 20, shard_bytes)):
                if now.size and now.size + int(offs[j] - offs[i]) > shard_bytes:
                    yield _shard_batch(now.closed(number))
                    number, now = number + 1, _Open([], [], [])
                now.add(batch.column("doc_id").slice(i, j - i).to_pylist(), buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        if now.rows:
            yield _shard_batch(now.closed(number))

    path = path or fresh_path(spark, "lexical-index")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SHARD)
    # small row groups: whoever reads a shard holds only those beside it
    found.write.option("parquet.block.size", max(1 << 20, shard_bytes)).parquet(path)
    return spark.read.schema(SHARD).parquet(path)


@dataclass
class Queries:
    """Queries by row: their items, and for each the terms, weights and how often each term occurs in it."""

    items: list[tuple[int | None, int]]
    terms: list[np.ndarray]
    weights: list[np.ndarray]


def weight_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


class Postings:
    """A sorted list of (document, score) with its bounds: for the shard and for each range of documents."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, ranges: int):
        self.docs, self.scores = docs, scores
        self.bound = int(scores.max()) if len(scores) else 0
        self.at = np.searchsorted(docs, np.arange(ranges + 1) * RANGE)
        self.bounds = np.zeros(ranges, dtype=np.int64)
        full = np.flatnonzero(np.diff(self.at))
        if len(full):
            self.bounds[full] = np.maximum.reduceat(scores, self.at[full])

    def times(self, weight: int) -> "Postings":
        """The same list with every score `weight` times as high."""
        out = object.__new__(Postings)
        out.docs, out.scores, out.at = self.docs, self.scores * weight, self.at
        out.bound, out.bounds = self.bound * weight, self.bounds * weight
        return out

    def lookup(self, docs: np.ndarray, r: int) -> np.ndarray:
        """The scores of `docs`, all of range r; zero where a document isn't in the list."""
        a, b = self.at[r], self.at[r + 1]
        if a == b:
            return np.zeros(len(docs), dtype=np.int64)
        at = np.minimum(a + np.searchsorted(self.docs[a:b], docs), b - 1)
        return np.where(self.docs[at] == docs, self.scores[at], 0)


def summed(lists: list[Postings], ranges: int) -> Postings:
    """Term at a time: the accumulators of `lists` as one list."""
    docs, scores = np.concatenate([x.docs for x in lists]), np.concatenate([x.scores for x in lists])
    order = np.argsort(docs, kind="stable")
    own, first = np.unique(docs[order], return_index=True)
    return Postings(own, np.add.reduceat(scores[order], first) if len(own) else scores, ranges)


def walk(lists: list[Postings], ranges: int, k: int, least: int, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Document at a time over `lists`: (documents, scores) of at least `least` among which are the k best.

    Ties with the k-th score stay, as another shard's documents may come between
    them.  `seen` gets the number of documents scored.
    """
    lists = sorted((x for x in lists if len(x.docs)), key=lambda x: x.bound)
    top_docs, top = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = max(least, 1)
    bounds = np.stack([x.bounds for x in lists]) if lists else np.zeros((0, ranges), np.int64)
    for r in range(ranges if lists else 0):
        own = bounds[:, r]
        upto = np.cumsum(own)  # what the lists before and with each can add in this range
        if upto[-1] < least:
            continue
        first = int(np.searchsorted(upto, least))  # lists before it offer no candidates
        offered = [x for x in lists[first:] if x.at[r] < x.at[r + 1]]
        docs = np.unique(np.concatenate([x.docs[x.at[r] : x.at[r + 1]] for x in offered]))
        scores = np.zeros(len(docs), dtype=np.int64)
        for x in offered:
            scores += x.lookup(docs, r)
        for i in range(first - 1, -1, -1):
            live = scores + upto[i] >= least
            docs, scores = docs[live], scores[live]
            if not len(docs):
                break
            scores = scores + lists[i].lookup(docs, r)
        if seen is not None:
            seen.append(len(docs))
        live = scores >= least
        if live.any():
            top_docs, top = np.concatenate([top_docs, docs[live]]), np.concatenate([top, scores[live]])
            if len(top) >= k:
                least = max(least, int(np.partition(top, len(top) - k)[len(top) - k]))
                top_docs, top = top_docs[top >= least], top[top >= least]
    return top_docs, top


class Shard:
    """One row of the index, opened."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids, self.null = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["null_ids"], bool)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.damping = 75 + 25 * lengths * n_docs // max(n_terms, 1)
        self.terms, df = row["terms"], row["df"]
        self.upto = np.concatenate([[0], np.cumsum(df)])
        self.docs, self.tfs = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["tfs"], np.int32)
        self.ranges = -(-len(self.ids) // RANGE)
        self.known: dict[int, Postings | None] = {}

    def postings(self, term: int) -> Postings | None:
        """The list of `term` with scores before any weight; None without one."""
        if term not in self.known:
            at = int(np.searchsorted(self.terms, term))
            if at == len(self.terms) or self.terms[at] != term:
                self.known[term] = None
            else:
                own = slice(int(self.upto[at]), int(self.upto[at + 1]))
                docs, tf = self.docs[own].astype(np.int64), self.tfs[own].astype(np.int64)
                self.known[term] = Postings(docs, 1_000_000_000 * tf // (1000 * tf + 12 * self.damping[docs]), self.ranges)
        return self.known[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        short, long = [], []
        for term, weight in zip(terms.tolist(), weights.tolist(), strict=True):
            if weight and (own := self.postings(term)) is not None:
                (short if len(own.docs) * SHORT <= len(self.ids) else long).append(own.times(weight))
        if len(short) > 1:
            short = [summed(short, self.ranges)]
        return walk([*short, *long], self.ranges, k, least, seen)


def _parts(queries: DataFrame, part_bytes: int) -> Iterator[list[tuple[int | None, int, str]]]:
    """Queries (item, number, text) in parts of bounded size; every distinct (item_id, text) is one."""
    named = queries.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    total = named.agg(F.sum(F.octet_length("text") * (1 + TERM_BYTES // 2) + TERM_BYTES)).first()[0] or 0
    parts = -(-total // part_bytes)
    for p in range(parts):
        yield [tuple(r) for r in named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).select("item_id", F.xxhash64("text").alias("number"), "text").collect()]


def search(index: DataFrame, queries: DataFrame, k: int = TOP, part_bytes: int = BROADCAST_BYTES // 4) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of `index` for each row of `queries` (item_id, text).

    A term that df of N documents hold weighs w = floor(1000 ln((2N + 2) / (2df + 1))).
    A document of n terms that holds it tf times gets w * (10^9 tf div (1000 tf + 12 m))
    for each of its occurrences in the query, with m = 75 + 25 n N div (all terms).
    Only scores above zero rank; equal ones by doc_id, null last.  Repeated rows of
    `queries` are one query; texts that share an item_id are ranked each for itself,
    under that id.  Queries without terms, null texts among them, find nothing, as
    all do in an empty index.  Queries are sent in parts of `part_bytes`; more of
    them take further passes over the index.
    """
    spark = index.sparkSession
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    found = spark.createDataFrame([], "item_id long, number long, doc_id long, score long")
    for part in _parts(queries, part_bytes):
        raw = [text.encode() for *_, text in part]
        h, bounds = term_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        counts = [Counter(h[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        wanted = sorted(set().union(*counts))
        terms = spark.createDataFrame([(t,) for t in wanted], "term long")
        held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
        df = dict(map(tuple, held.join(F.broadcast(terms), "term").groupBy("term").agg(F.sum("df")).collect()))
        ranked = [(item, number, c) for (item, number, _), c in zip(part, counts, strict=True) if c]
        own = [np.array(sorted(c), dtype=np.int64) for *_, c in ranked]
        weights = [weight_of(np.array([df.get(t, 0) for t in o.tolist()], dtype=np.float64), n_docs) * np.array([c[t] for t in o.tolist()]) for o, (*_, c) in zip(own, ranked, strict=True)]
        sent = spark.sparkContext.broadcast(Queries([(item, number) for item, number, _ in ranked], own, weights))
        found = found.unionByName(_searched(index, sent, int(n_docs), int(n_terms), k))

    # the best of some tasks, then of all: no task sees what every task has found for an item
    by = Window.partitionBy("item_id", "number", "salt").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    some = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).drop("rank", "salt")
    by = Window.partitionBy("item_id", "number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return some.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _searched(index: DataFrame, sent, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, number, doc_id, score): what each task's shards have to offer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        # the k best so far of each query: scores, ids, and whether the id is null
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries.items]
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() if c not in ("terms", "df") else batch.column(c)[r].values.to_numpy() for c in ("ids", "null_ids", "lengths", "terms", "df", "docs", "tfs")}
                shard = Shard(row, n_docs, n_terms)
                for q, (terms, weights) in enumerate(zip(queries.terms, queries.weights, strict=True)):
                    scores, ids, null = best[q]
                    docs, got = shard.search(terms, weights, k, int(scores[-1]) if len(scores) == k else 1)
                    if len(docs):
                        scores, ids, null = np.concatenate([scores, got]), np.concatenate([ids, shard.ids[docs]]), np.concatenate([null, shard.null[docs]])
                        order = np.lexsort((ids, null, -scores))[:k]
                        best[q] = scores[order], ids[order], null[order]
        n = [len(scores) for scores, *_ in best]
        scores, ids, null = (np.concatenate([b[c] for b in best]) if best else np.zeros(0, np.int64) for c in range(3))
        items = [item for (item, _), m in zip(queries.items, n, strict=True) for _ in range(m)]
        numbers = [number for (_, number), m in zip(queries.items, n, strict=True) for _ in range(m)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(numbers, pa.int64()), pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(scores, pa.int64())], ["item_id", "number", "doc_id", "score"]
        )

    return index.select("ids", "null_ids", "lengths", "terms", "df", "docs", "tfs").mapInArrow(run, "item_id long, number long, doc_id long, score long")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best of `docs` for each of `queries`; see `build_index` and `search`."""
    return search(build_index(docs, shard_bytes=shard_bytes), queries, k)
