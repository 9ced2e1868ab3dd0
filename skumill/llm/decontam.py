"""Benchmark decontamination with a broadcast set of normalised test windows.

The test items are cut into windows of `n` consecutive words (an item of fewer
words is one window).  Their 64-bit hashes form a sorted array that every executor
gets, beside the items' normalised bytes; each document's windows are looked up in
it with a few array passes and every hit is compared byte by byte with the item's
own window, so a hash collision never marks a document.  Documents are not shuffled.

The set is sent in parts of at most `part_bytes` as built: a larger benchmark takes
further passes over the documents, one for each part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, refuse_clashes
from .textscan import LOWER, WORD, column_bytes, row_of, slices, span_hashes, window_hashes, word_spans

WINDOW = 10


#: Bytes of the built set for each word of an item, at most: a hash, two offsets and the item's number.
WORD_BYTES = 24
#: What a null item_id is called in a digest.
NULL_ID = "null"


@dataclass
class Windows:
    """The windows of one length, sorted by hash: bytes text[at:end] of item `item`."""

    keys: np.ndarray
    at: np.ndarray
    end: np.ndarray
    item: np.ndarray


@dataclass
class Benchmark:
    """Every window by its length, the items' words joined by single spaces, and the items' names (None for a null id)."""

    by_length: dict[int, Windows]
    text: np.ndarray
    names: list[str | None]

    def nbytes(self) -> int:
        return self.text.nbytes + sum(a.nbytes for w in self.by_length.values() for a in (w.keys, w.at, w.end, w.item))


def item_windows(items: list[tuple[str | None, str]], n: int = WINDOW) -> Benchmark:
    """The set of (item_id, text) pairs."""
    names = list(dict.fromkeys(i for i, _ in items))
    number = {name: k for k, name in enumerate(names)}
    raw, found, size = [], {}, 0
    for item_id, text in items:
        low = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
        starts, ends, _ = word_spans(low, np.array([0, len(low)]), WORD)
        if not len(starts):
            continue
        h, lens, k = span_hashes(low, starts, ends), ends - starts, min(n, len(starts))
        raw.append(b" ".join(low[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)))
        at = size + np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        found.setdefault(k, []).append((window_hashes(h, k), at[: len(at) - k + 1], (at + lens)[k - 1 :], np.full(len(at) - k + 1, number[item_id])))
        size += len(raw[-1])
    by_length = {}
    place = np.uint32 if size < 2**32 else np.uint64
    for k, own in found.items():
        keys, at, end, item = (np.concatenate(c) for c in zip(*own, strict=True))
        order = np.argsort(keys, kind="stable")
        by_length[k] = Windows(keys[order], at[order].astype(place), end[order].astype(place), item[order].astype(np.uint32))
    return Benchmark(by_length, np.frombuffer(b"".join(raw), dtype=np.uint8), names)


def hits(buf: np.ndarray, offs: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set[str | None]]]:
    """Of each row: the word bounds, starts, ends, which words are hit, and the items by row."""
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, WORD)
    h = span_hashes(low, starts, ends)
    row = row_of(bounds)
    hit = np.zeros(len(h), dtype=bool)
    items: dict[int, set[str | None]] = {}
    for size, w in bench.by_length.items():
        runs = window_hashes(h, size)
        if not len(runs):
            continue
        first = np.searchsorted(w.keys, runs)
        same = np.flatnonzero((w.keys[np.minimum(first, len(w.keys) - 1)] == runs) & (row[: len(runs)] == row[size - 1 :]))
        last = np.searchsorted(w.keys, runs[same], side="right")
        known: dict[bytes, set[str | None]] = {}
        for p, a, b in zip(same.tolist(), first[same].tolist(), last.tolist(), strict=True):
            words = b" ".join(low[i:j].tobytes() for i, j in zip(starts[p : p + size].tolist(), ends[p : p + size].tolist(), strict=True))
            own = known.get(words)
            if own is None:
                own = known[words] = {bench.names[w.item[k]] for k in range(a, b) if bench.text[w.at[k] : w.end[k]].tobytes() == words}
            if own:
                hit[p : p + size] = True
                items.setdefault(int(row[p]), set()).update(own)
    return bounds, starts, ends, hit, items


def _parts(bench: DataFrame, part_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in parts whose built sets have about `part_bytes` at most, by a hash of their id and text."""
    named = bench.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = named.agg(F.sum(F.octet_length("text") + words * WORD_BYTES + 64)).first()[0] or 0
    parts = -(-total // part_bytes) or 1
    for k in range(parts):
        yield [tuple(r) for r in named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()]


def mark_hits(docs: DataFrame, bench: DataFrame, n: int = WINDOW, part_bytes: int = BROADCAST_BYTES, prefix: str = "__") -> DataFrame:
    """`docs` with the columns n_words, n_hit, spans (byte ranges of hit words) and items, each behind `prefix`.

    Words are runs of ASCII letters and digits and of non-ASCII characters, with
    A-Z read as a-z.  A null or empty text has no words.  An item without words
    marks nothing; an item whose id is null is one of its own, null among the items;
    repeated items count once.  Empty tables give no hits.  Columns of `docs` with
    a name of these four raise.
    """
    spark = docs.sparkSession
    long, text = T.LongType(), T.StringType()
    made = {"n_words": long, "n_hit": long, "spans": T.ArrayType(long), "items": T.ArrayType(text)}
    names = [prefix + name for name in made]
    refuse_clashes(docs, *names)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, kind) for name, kind in zip(names, made.values(), strict=True)]])
    docs = docs.select("*", *[(F.lit(0) if kind == long else F.array()).cast(kind).alias(name) for name, kind in zip(names, made.values(), strict=True)])
    for part in _parts(bench, part_bytes):
        sent = spark.sparkContext.broadcast(item_windows(part, n))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows = sent.value
            for batch in batches:
                buf, offs = column_bytes(batch.column("text"))
                for i, j in slices(offs):
                    some = batch.slice(i, j - i)
                    at = offs[i : j + 1] - offs[i]
                    bounds, starts, ends, hit, items = hits(buf[offs[i] : offs[j]], at, windows)
                    spans, known, count = some.column(names[2]).to_pylist(), some.column(names[3]).to_pylist(), np.zeros(j - i, np.int64)
                    for r, own in items.items():
                        a, b = int(bounds[r]), int(bounds[r + 1])
                        before = np.array(spans[r], dtype=np.int64).reshape(-1, 2)
                        mine = hit[a:b] | np.isin(starts[a:b] - at[r], before[:, 0])
                        which = a + np.flatnonzero(mine)
                        spans[r] = np.column_stack([starts[which] - at[r], ends[which] - at[r]]).ravel().tolist()
                        known[r] = sorted({*known[r], *own}, key=lambda x: (NULL_ID if x is None else x, x is None))
                    for r, s in enumerate(spans):
                        count[r] = len(s) // 2
                    cols = [*some.columns[:-4], pa.array(np.diff(bounds), pa.int64()), pa.array(count), pa.array(spans, pa.list_(pa.int64())), pa.array(known, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

        docs = docs.mapInArrow(run, schema)
    return docs


def contamination(docs: DataFrame, bench: DataFrame, n: int = WINDOW, part_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of `docs`; a null item_id reads `null` in the digest."""
    marked = mark_hits(docs.select("doc_id", F.col("text").cast("string").alias("text")), bench, n, part_bytes)
    return marked.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",", NULL_ID), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


def without_benchmark(docs: DataFrame, bench: DataFrame, remove: str = "documents", n: int = WINDOW, part_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`docs`, with its own columns whatever their names, without its hit documents or without the hit words.

    remove="documents" drops each row with a hit word; remove="spans" keeps all
    rows and cuts the hit words out of their texts, with the bytes between two
    neighbouring hit words.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    marked = mark_hits(docs, bench, n, part_bytes, prefix)
    own = docs.columns
    if remove == "documents":
        return marked.where(F.col(f"{prefix}n_hit") == 0).select(*own)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(f"{prefix}spans").to_pylist(), strict=True):
                if spans:
                    raw, out, at = text.encode(), [], 0
                    edges = np.array(spans).reshape(-1, 2)
                    inside = np.array([WORD[LOWER[np.frombuffer(raw[a:b], np.uint8)]].any() for a, b in zip(edges[:-1, 1], edges[1:, 0], strict=True)], dtype=bool)
                    firsts = np.concatenate([[True], inside])
                    lasts = np.concatenate([inside, [True]])
                    for a, b in zip(edges[firsts, 0].tolist(), edges[lasts, 1].tolist(), strict=True):
                        out.append(raw[at:a])
                        at = b
                    text = (b"".join(out) + raw[at:]).decode()
                texts.append(text)
            k = batch.schema.get_field_index("text")
            cols = [pa.array(texts, pa.string()) if c == k else batch.column(c) for c, name in enumerate(batch.schema.names) if name in own]
            yield pa.RecordBatch.from_arrays(cols, own)

    return marked.mapInArrow(cut, T.StructType([f for f in marked.schema.fields if f.name in own]))


def sha256_of_items(ids: list[str]) -> str:
    """The digest of `contamination`, for checks."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
