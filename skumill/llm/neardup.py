"""MinHash near-duplicate components with sequential Bayesian verification.

A document is the set of its distinct five-word shingles.  Two documents are
linked when the Jaccard similarity of their full sets reaches `percent` / 100;
a component is what links connect.

1. One scan cuts every whole text into shingles and keeps a MinHash signature,
   the set size and a 128-bit fingerprint of the set.  Documents with equal sets
   are one class with a number of its own; the smallest (doc_id, digest of the
   text) represents it, as a doc_id alone may stand for several texts.
2. Signatures are banded.  A bucket's members are compared in blocks of a fixed
   size: the matches of successive signature batches give a Beta posterior of the
   similarity, and a pair goes as soon as the chance of reaching the threshold
   falls under `miss`.  Each block reports a spanning forest of what is left, not
   its pairs, and the forests' components are the plausible clusters.
3. The texts of plausible clusters are cut again, and the pairs that share a band
   and survive the same pruning are verified on the full sets, again in blocks.

No bucket, cluster or candidate list is capped: a large one only has more blocks.

Shingles are compared as 64-bit hashes and sets as fingerprints and sizes.  Two
texts of m shingles in all hold two shingles of one hash with a chance under
m^2 / 2^65 (3e-12 for 10 000 shingles); only then could a verified similarity be
wrong.  Two of n different sets share a fingerprint with a chance under n^2 / 2^129
(2e-17 for 10^11 texts).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, free_name, spread_join, stored, with_maybe_in
from .textscan import LOWER, NON_SPACE, column_bytes, mix, slices, span_hashes, window_hashes, word_spans

SHINGLE = 5
PERCENT = 85
HASHES = 192
#: Chance of a pair at the threshold to share no band.
UNSEEN = 3e-7
#: Signature places compared between two looks at the posterior.
BATCH = 32
#: Chance of pruning a pair that reaches the threshold.
MISS = 1e-9
#: Documents of one block; a task compares two blocks at a time.
BLOCK = 256
#: Shingles of two blocks up to which they get small numbers.
CODED = 2_000_000


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(0, 2**63, HASHES, dtype=np.uint64), rng.integers(0, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer than k words make one shingle."""
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, NON_SPACE)
    h = span_hashes(low, starts, ends)
    runs = window_hashes(h, k)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out.append(np.unique(runs[a : b - k + 1]) if b - a >= k else window_hashes(h[a:b], b - a) if b > a else h[:0])
    return out


def fingerprints(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Both 64-bit halves of the fingerprint of each set."""
    return [np.array([int(f(s).sum(dtype=np.uint64)) for s in sets], dtype=np.uint64).view(np.int64) for f in (lambda s: s, lambda s: mix(s ^ np.uint64(0x5851F42D4C957F2D)))]


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """A row of HASHES minima (upper 32 bits) for each non-empty set, else all ones."""
    xors, mults = _seeds()
    out = np.full((len(sets), HASHES), 0xFFFFFFFF, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for j in range(HASHES):
            v = ((flat ^ xors[j]) * mults[j]) >> np.uint64(32)
            out[full, j] = np.minimum.reduceat(v.astype(np.uint32), at)
    return out


@lru_cache
def bands_for(percent: int = PERCENT) -> tuple[int, int]:
    """(bands, rows) with the most rows that miss a pair at the threshold with a chance of `UNSEEN` at most."""
    for rows in range(HASHES, 0, -1):
        bands = HASHES // rows
        if (1 - (percent / 100) ** rows) ** bands <= UNSEEN:
            return bands, rows
    raise ValueError(f"{HASHES} places cannot find pairs at {percent} percent")


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature; the band's number is part of it."""
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(sig), 1), np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, r])
    return key


@lru_cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """After n compared places, the matches below which a pair is pruned.

    With a uniform prior, m matches of n leave Beta(m + 1, n - m + 1); its mass
    over t is the chance of at most m successes in n + 1 draws at t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass = 0.0
        for m in range(n + 1):
            mass += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if mass >= miss:
                out.append((n, m))
                break
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a[i], b[j]) that the posterior leaves, batch by batch."""
    done, got = 0, np.zeros(len(i), np.int32)
    for n, least in least_matches(percent, miss):
        if not len(i):
            break
        got = got + (a[i, done:n] == b[j, done:n]).sum(axis=1, dtype=np.int32)
        keep = got >= least
        i, j, got, done = i[keep], j[keep], got[keep], n
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest connected index of each of n items."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]  # roots, as every label is one between passes
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        live = label[i] != label[j]
        i, j = i[live], j[live]
    return label


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of a sorted partition, across batch bounds."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row indexes of the first and the second block of a group; the same ones on the diagonal."""
    if t["i"][0].as_py() == t["j"][0].as_py():
        every = np.arange(t.num_rows)
        return every, every
    blk = t["blk"].to_numpy()
    return np.flatnonzero(blk == t["i"][0].as_py()), np.flatnonzero(blk == t["j"][0].as_py())


def _views(col: pa.ChunkedArray) -> list[np.ndarray]:
    """The shingle sets of a binary column, without a copy."""
    out = []
    for chunk in col.chunks:
        _, offs, data = chunk.buffers()
        o = np.frombuffer(offs, dtype=np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].tolist()
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        out += [raw[a:b].view(np.uint64) for a, b in zip(o[:-1], o[1:], strict=True)]
    return out


def _marked(flat: list[np.ndarray]) -> Callable[[int, list[int]], np.ndarray]:
    """What set h has in common with others, by marks on small numbers: fast, but some 60 bytes a shingle."""
    _, code = np.unique(np.concatenate(flat), return_inverse=True)
    at = np.concatenate([[0], np.cumsum([len(s) for s in flat])])
    mark = np.zeros(int(code.max()) + 1, dtype=np.int64)

    def common(h: int, others: list[int]) -> np.ndarray:
        mark[code[at[h] : at[h + 1]]] = 1
        both = np.array([mark[code[at[r] : at[r + 1]]].sum() for r in others])
        mark[code[at[h] : at[h + 1]]] = 0
        return both

    return common


def _searched(flat: list[np.ndarray]) -> Callable[[int, list[int]], np.ndarray]:
    """The same by binary search in the sorted sets, without memory of its own."""

    def one(a: np.ndarray, b: np.ndarray) -> int:
        few, many = (a, b) if len(a) < len(b) else (b, a)
        return int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())

    return lambda h, others: np.array([one(flat[h], flat[r]) for r in others])


def _edge_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])
    v = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _in_blocks(df: DataFrame, group: str, size: str, by: str = "cls") -> DataFrame:
    """One row for each pair of blocks that a row takes part in: (group, i, j), i <= j."""
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    dealt = df.withColumn("_n", blocks).withColumn("blk", F.pmod(F.xxhash64(by), F.col("_n")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    dealt = dealt.withColumn("i", F.least("blk", "_o")).withColumn("j", F.greatest("blk", "_o")).drop("_n", "_o", size)
    return dealt.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _digest(text: Column) -> Column:
    """128 bits that tell the texts of one doc_id apart."""
    return F.unhex(F.md5(text.cast("binary")))


def scan(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, n_shingles, fp1, fp2, sig) of every document; fp1 is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            for i, j in slices(offs, 1 << 20):
                sets = shingle_sets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                sig = signatures_of(sets)
                empty = np.array([not len(s) for s in sets], dtype=bool)
                fp = fingerprints(sets)
                own = [batch.column(n).slice(i, j - i) for n in ("doc_id", "digest")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.int64(), mask=empty) for x in fp), pa.array([row.tobytes() for row in sig], pa.binary())],
                    ["doc_id", "digest", "n_shingles", "fp1", "fp2", "sig"],
                )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _digest(text).alias("digest")).mapInArrow(run, "doc_id long, digest binary, n_shingles long, fp1 long, fp2 long, sig binary")


def _plausible_edges(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Spanning edges of what the posterior leaves in each bucket; members: (bucket, cls, sig, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for t in _groups(batches, ["bucket", "i", "j"]):
            if t.num_rows < 2:
                continue
            ids, sig = t["cls"].to_numpy(), _matrix(t["sig"])
            a, b = _sides(t)
            if not len(a) or not len(b):
                continue
            x, y = (g.ravel() for g in np.meshgrid(np.arange(len(a)), np.arange(len(b)), indexing="ij"))
            keep = a[x] < b[y] if a is b else np.ones(len(x), bool)
            x, y = plausible(sig, sig, a[x[keep]], b[y[keep]], percent, miss)
            label = _forest(len(ids), x, y)
            own = np.flatnonzero(label != np.arange(len(ids)))
            if len(own):
                found.append((ids[own], ids[label[own]]))
            if len(found) > 500:
                yield _edge_batch(found)
                found = []
        yield _edge_batch(found)

    return _in_blocks(members, "bucket", "size").mapInArrow(run, "u long, v long")


def _exact_edges(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Spanning edges of the exact links in each cluster; members: (cluster, cls, sig, shingles, size)."""
    bands, width = bands_for(percent)
    coded = CODED

    def linked(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, sig = t["cls"].to_numpy(), _matrix(t["sig"])
        a, b = _sides(t)
        keys = band_keys(sig, bands, width)
        share = np.zeros((len(a), len(b)), dtype=bool)
        for k in range(bands):
            share |= keys[a, k][:, None] == keys[b, k][None, :]
        if a is b:
            share = np.triu(share, 1)
        x, y = plausible(sig, sig, *(s[n] for s, n in zip((a, b), np.nonzero(share), strict=True)), percent, miss)
        if not len(x):
            return ids[:0], ids[:0]
        flat = _views(t["shingles"])
        sizes = np.array([len(s) for s in flat])
        common = _marked(flat) if sizes.sum() <= coded else _searched(flat)
        label = np.arange(len(ids))
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        heads, first = np.unique(x, return_index=True)
        for h, lo, hi in zip(heads.tolist(), first.tolist(), [*first[1:].tolist(), len(x)], strict=True):
            rest = y[lo:hi]
            rest = rest[label[rest] != label[h]]
            if not len(rest):
                continue
            both = common(h, rest.tolist())
            hit = rest[100 * both >= percent * (sizes[h] + sizes[rest] - both)]
            for other in np.unique(label[hit]).tolist():
                low, high = sorted((int(label[h]), other))
                label[label == high] = low
        own = np.flatnonzero(label != np.arange(len(ids)))
        return ids[own], ids[label[own]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for t in _groups(batches, ["cluster", "i", "j"]):
            if t.num_rows > 1:
                found.append(linked(t))
            if len(found) > 500:
                yield _edge_batch(found)
                found = []
        yield _edge_batch(found)

    return _in_blocks(members, "cluster", "size").mapInArrow(run, "u long, v long")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            for i, j in slices(offs, 1 << 20):
                sets = shingle_sets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                own = [batch.column(n).slice(i, j - i) for n in ("cls", "cluster", "size", "sig")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "cluster", "size", "sig", "shingles"])

    return docs.select("cls", "cluster", "size", "sig", "text").mapInArrow(run, "cls long, cluster long, size long, sig binary, shingles binary")


def _labelled(docs: DataFrame, percent: int, k: int, miss: float) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, leads) of every row; leads marks one text of each component."""
    n_bands, width = bands_for(percent)
    sigs = stored(scan(docs, k), "signatures")
    named = sigs.where("doc_id is not null and fp1 is not null")
    classes = named.groupBy("fp1", "fp2", "n_shingles").agg(F.min(F.struct("doc_id", "digest")).alias("rep"), F.first("sig").alias("sig"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")  # numbers stay as written

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = band_keys(_matrix(pa.chunked_array([batch.column(1)])), n_bands, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel(), pa.int64()), pa.array(np.repeat(batch.column(0).to_numpy(), n_bands), pa.int64())], ["bucket", "cls"])

    bands = classes.select("cls", "sig").mapInArrow(keys, "bucket long, cls long")
    sizes = stored(bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    shared = stored(spread_join(bands, sizes, "bucket", F.col("cls")), "members")
    edges = stored(_plausible_edges(shared.join(classes.select("cls", "sig"), "cls"), percent, miss), "plausible")
    discard(shared)
    discard(sizes)

    clusters = stored(components(edges), "clusters")
    discard(edges)
    many = clusters.groupBy("component").agg(F.count("*").alias("size"))
    inside = spread_join(clusters, many, "component", F.col("node")).select(F.col("node").alias("cls"), F.col("component").alias("cluster"), "size")
    inside = stored(inside.join(classes.select("cls", "sig", "rep.doc_id", "rep.digest"), "cls"), "inside")
    discard(clusters)
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(text).alias("digest"), text.alias("text")).where("doc_id is not null and digest is not null")
    texts = with_maybe_in(texts, inside, ["doc_id", "digest"], "_maybe").where("_maybe").drop("_maybe")
    # rows that repeat an id and its text are one member; the join needs no shuffle beyond this one's
    sets = _sets(texts.dropDuplicates(["doc_id", "digest"]).join(inside, ["doc_id", "digest"]), k)
    links = stored(_exact_edges(sets, percent, miss), "links")
    discard(inside)

    found = stored(components(links), "components")
    discard(links)
    of_class = found.join(classes.select(F.col("cls").alias("node"), "rep"), "node")
    leads = of_class.groupBy("component").agg(F.min("rep").alias("lead"))
    leads = spread_join(found, leads, "component", F.col("node")).select(F.col("node").alias("cls"), "lead")
    named_classes = classes.join(leads, "cls", "left").select("fp1", F.col("fp2").alias("_fp2"), F.col("n_shingles").alias("_n"), F.coalesce("lead", "rep").alias("_lead"))
    named_classes = stored(named_classes, "named")
    rows = sigs.select("doc_id", "digest", "n_shingles", "fp1", "fp2")
    linked = spread_join(rows.where("doc_id is not null and fp1 is not null"), named_classes, "fp1", F.col("doc_id")).where("fp2 = _fp2 and n_shingles = _n")
    linked = linked.select("doc_id", "digest", "n_shingles", F.col("_lead.doc_id").alias("component_id"), ((F.col("doc_id") == F.col("_lead.doc_id")) & (F.col("digest") == F.col("_lead.digest"))).alias("leads"))
    alone = rows.where("doc_id is null or fp1 is null").select("doc_id", "digest", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("leads"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE, miss: float = MISS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach, the document itself
    included; kept says that it is this document.  Words end at ASCII white
    space and A-Z counts as a-z.  A null or wordless text has no shingles and is
    linked with nothing; a text of one to k - 1 words is one shingle.  A row whose
    doc_id is null is never linked: its component is null and it is kept.
    Repeated rows are equal documents; the texts of a repeated doc_id are linked
    each for itself.  Other columns of `docs` are ignored.  An empty table gives
    an empty result.
    """
    found = _labelled(docs, percent, k, miss).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE, miss: float = MISS) -> DataFrame:
    """The rows of `docs`, all columns, that near-duplicate removal leaves: one text of each component, that of its smallest doc_id.

    A row goes by its doc_id and text, so that a text stays although another one
    of its doc_id goes.  Of a component with several texts of its smallest
    doc_id one stays, by digest; rows that repeat a doc_id and its text stay or go
    together.  Rows without doc_id or words stay.
    """
    gone = _labelled(docs, percent, k, miss).where(~F.col("leads"))
    by_id, by_text, maybe = (free_name(docs, n) for n in ("_gone_id", "_gone_text", "_maybe_gone"))
    gone = stored(gone.select(F.col("doc_id").alias(by_id), F.col("digest").alias(by_text)).distinct(), "gone")
    marked = docs.withColumn(by_id, F.col("doc_id").cast("long")).withColumn(by_text, _digest(F.col("text").cast("string")))
    marked = with_maybe_in(marked, gone, [by_id, by_text], maybe)
    # only rows that may go are shuffled to find out
    stay = marked.where(F.col(maybe)).join(gone, [by_id, by_text], "left_anti")
    return marked.where(~F.col(maybe)).unionByName(stay).select(*docs.columns)
