"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE consecutive words.  Every passage is
encoded from its form (shares of byte classes, word lengths, repetition within the
passage and across the document) and from its words: the mean of the embeddings of
its words and of its pairs of neighbouring words, which are looked up by hash in a
table of BUCKETS rows that is learned with the rest.  A gated attention layer learns
from document labels how much each passage counts, and the document's score is that
of the attention-weighted passage representation.

    h = relu(x A + e D + a)     w = softmax(v . (tanh(h B) * sigmoid(h C)))
    score = sigmoid(u . sum(w h) + c)

The model is fitted on at most `most` labelled documents, chosen by a hash of
their id; every document is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import refuse_clashes
from .textscan import LOWER, NON_SPACE, column_bytes, row_of, slices, span_hashes, window_hashes, word_spans

PASSAGE = 48
#: Labelled documents that the model is fitted on, at most.
MOST = 8000
HIDDEN, GATE = 32, 16
#: Rows and columns of the table of embeddings; row 0 stays zero and stands for no pair.
BUCKETS, WIDTH = 1 << 13, 8
#: Share of a passage's words and pairs that a training step leaves out.
LEFT_OUT = 0.3
#: Training steps, at most: fewer rounds over more documents.
STEPS = 400

_CLASSES = np.full(256, 11, dtype=np.uint8)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r", b".", b",", b"!?", b"|", b"*#$%&", b"-_=+~^<>/\\@", b"", range(128, 256))):
    _CLASSES[list(_bytes)] = _k
N_CLASSES = 13
FEATURES = N_CLASSES + 9


@dataclass
class Passages:
    """The passages of some rows: features of each, its first place in `words`, and the n + 1 passage bounds of the rows.

    words has two buckets for each word: its own and that of the pair with the next one of its passage.
    """

    x: np.ndarray
    words: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    def rows(self) -> list[Passages]:
        """Each row by itself."""
        out, ends = [], np.append(self.first, len(self.words))
        for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            out.append(Passages(self.x[a:b], self.words[ends[a] : ends[b]], self.first[a:b] - ends[a], np.array([0, b - a])))
        return out


def joined(rows: list[Passages]) -> Passages:
    at = np.cumsum([0, *(len(r.words) for r in rows)])
    first = np.concatenate([r.first + a for r, a in zip(rows, at, strict=False)])
    return Passages(np.concatenate([r.x for r in rows]), np.concatenate([r.words for r in rows]), first, np.cumsum([0, *(len(r.x) for r in rows)]))


def no_passage() -> Passages:
    return Passages(np.zeros((0, FEATURES), np.float32), np.zeros((0, 2), np.int16), np.zeros(0, np.int64), np.zeros(1, np.int64))


def _buckets(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The two buckets of each word; `last` are the places of the passages' last words, which begin no pair."""
    of = lambda v: (1 + (v >> np.uint64(40)) % np.uint64(BUCKETS - 1)).astype(np.int16)
    out = np.zeros((len(h), 2), dtype=np.int16)
    out[:, 0] = of(h)
    out[:-1, 1] = of(window_hashes(h, 2))
    out[last, 1] = 0
    return out


def encode(buf: np.ndarray, offs: np.ndarray) -> Passages:
    """The passages of each row; a wordless row has none."""
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, NON_SPACE)
    counts = np.diff(bounds)
    passages = -(-counts // PASSAGE)
    pb = np.concatenate([[0], np.cumsum(passages)])
    n = int(pb[-1])
    if not n:
        return replace(no_passage(), bounds=pb)
    row = row_of(pb)
    first = bounds[:-1][row] + (np.arange(n) - pb[:-1][row]) * PASSAGE
    last = np.minimum(first + PASSAGE, bounds[1:][row])
    size = last - first
    x = np.empty((n, FEATURES), dtype=np.float32)
    # bytes: from a passage's first word to its last word's end
    a, b = starts[first], ends[last - 1]
    kinds = _CLASSES[buf]
    cuts = np.column_stack([a, np.minimum(b, len(buf) - 1)]).ravel()
    for k in range(N_CLASSES):
        got = np.add.reduceat((kinds == k).view(np.uint8), cuts, dtype=np.int32)[::2]
        x[:, k] = got / (b - a)
    h = span_hashes(low, starts, ends)
    lens = (ends - starts).astype(np.float32)
    mean = np.add.reduceat(lens, first) / size
    x[:, N_CLASSES] = np.log1p(mean)
    x[:, N_CLASSES + 1] = np.log1p(np.sqrt(np.maximum(np.add.reduceat(lens * lens, first) / size - mean * mean, 0)))
    x[:, N_CLASSES + 2] = np.log1p(np.maximum.reduceat(lens, first))
    again = np.zeros(len(h), dtype=np.int32)
    again[1:] = h[1:] == h[:-1]
    again[bounds[:-1][bounds[:-1] < len(h)]] = 0
    x[:, N_CLASSES + 3] = np.add.reduceat(again, first) / size
    # distinct words of the passage
    grid = np.minimum(first[:, None] + np.arange(PASSAGE)[None, :], last[:, None] - 1)
    words = np.sort(h[grid], axis=1)
    x[:, N_CLASSES + 4] = (1 + (words[:, 1:] != words[:, :-1]).sum(axis=1)) / size
    # word triples that the document repeats
    repeated = np.zeros(len(h), dtype=np.int32)
    runs = window_hashes(h, 3)
    for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if q - p > 3:
            own = runs[p : q - 2]
            order = np.argsort(own, kind="stable")
            same = own[order][1:] == own[order][:-1]
            repeated[p + order[1:][same]] = 1
            repeated[p + order[:-1][same]] = 1
    x[:, N_CLASSES + 5] = np.add.reduceat(repeated, first) / size
    x[:, N_CLASSES + 6] = size / PASSAGE
    x[:, N_CLASSES + 7] = np.log1p(counts[row])
    caps = np.zeros(len(h), dtype=np.int32)
    caps[:] = (_CLASSES[buf[starts]] == 1) & (_CLASSES[buf[ends - 1]] != 0)
    x[:, N_CLASSES + 8] = np.add.reduceat(caps, first) / size
    return Passages(x, _buckets(h, last - 1), first, pb)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class AttentionModel:
    """Gated-attention bag classifier in numpy; see the module's text."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        make = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        zero = lambda *s: np.zeros(s, np.float32)
        self.mean, self.std = zero(FEATURES), np.ones(FEATURES, np.float32)
        self.p = {"E": zero(BUCKETS, WIDTH), "D": make(WIDTH, HIDDEN), "A": make(FEATURES, HIDDEN), "a": zero(HIDDEN), "B": make(HIDDEN, GATE), "C": make(HIDDEN, GATE), "v": make(GATE), "u": make(HIDDEN), "c": zero(1)}

    def forward(self, bags: Passages, keep: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
        """Scores of rows none of which is without passages; `keep` weighs the words and pairs of a training step."""
        p, row, cut = self.p, row_of(bags.bounds), bags.bounds[:-1]
        z = (bags.x - self.mean) / self.std
        size = np.diff(bags.first, append=len(bags.words))[:, None].astype(np.float32)
        own = p["E"][bags.words[:, 0]], p["E"][bags.words[:, 1]]
        words = own[0] + own[1] if keep is None else own[0] * keep[:, :1] + own[1] * keep[:, 1:]
        e = np.add.reduceat(words, bags.first, axis=0) / size
        h = np.maximum(z @ p["A"] + e @ p["D"] + p["a"], 0)
        t, g = np.tanh(h @ p["B"]), _sigmoid(h @ p["C"])
        y = (t * g) @ p["v"]
        w = np.exp(y - np.maximum.reduceat(y, cut)[row])
        w = w / np.add.reduceat(w, cut)[row]
        bag = np.add.reduceat(w[:, None] * h, cut, axis=0)
        s = _sigmoid(bag @ p["u"] + p["c"])
        return s, {"z": z, "e": e, "size": size, "keep": keep, "h": h, "t": t, "g": g, "w": w, "bag": bag, "row": row, "cut": cut, "bags": bags}

    def score(self, bags: Passages) -> np.ndarray:
        """A score for every row; one without passages counts as one passage of zeros."""
        full = np.flatnonzero(np.diff(bags.bounds))
        out = np.empty(len(bags.bounds) - 1)
        if len(full) < len(out):
            nothing = Passages(np.zeros((1, FEATURES), np.float32), np.zeros((1, 2), np.int16), np.zeros(1, np.int64), np.array([0, 1]))
            out[:] = self.forward(nothing)[0][0]
        if len(full):
            out[full] = self.forward(replace(bags, bounds=np.append(bags.bounds[:-1][full], bags.bounds[-1])))[0]
        return out

    def fit(self, bags: list[Passages], labels: np.ndarray, epochs: int = 40, steps: int = STEPS, batch: int = 128, rate: float = 0.004, decay: float = 1e-4, seed: int = 11) -> AttentionModel:
        every = np.concatenate([b.x for b in bags])
        self.mean, self.std = every.mean(axis=0), every.std(axis=0) + 1e-3
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        rounds = -(-len(bags) // batch)
        epochs = max(1, min(epochs, steps // rounds))
        step, total = 0, epochs * rounds
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                one = joined([bags[k] for k in some])
                keep = (rng.random(one.words.shape, dtype=np.float32) >= LEFT_OUT) / np.float32(1 - LEFT_OUT)
                s, f = self.forward(one, keep)
                d = self._gradients((s - labels[some]).astype(np.float32) / len(some), f)
                step += 1
                now = rate * 0.5 * (1 + np.cos(np.pi * step / total))
                for k, g in d.items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    q[k] = 0.999 * q[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, ds: np.ndarray, f: dict) -> dict[str, np.ndarray]:
        p, row, w, h = self.p, f["row"], f["w"], f["h"]
        dbag = ds[:, None] * p["u"][None, :]
        per = dbag[row]
        dw = (per * h).sum(axis=1)
        de = w * (dw - np.add.reduceat(w * dw, f["cut"])[row])
        gate = de[:, None] * p["v"][None, :]
        dt, dg = gate * f["g"] * (1 - f["t"] ** 2), gate * f["t"] * f["g"] * (1 - f["g"])
        dh = (w[:, None] * per + dt @ p["B"].T + dg @ p["C"].T) * (h > 0)
        dwords = (dh @ p["D"].T) / f["size"]
        per_word = np.repeat(dwords, np.diff(f["bags"].first, append=len(f["bags"].words)), axis=0)
        table = np.zeros_like(p["E"])
        for side in (0, 1):
            ids, share = f["bags"].words[:, side].astype(np.intp), f["keep"][:, side]
            for k in range(WIDTH):
                table[:, k] += np.bincount(ids, per_word[:, k] * share, BUCKETS)
        table[0] = 0
        return {"E": table, "D": f["e"].T @ dh, "A": f["z"].T @ dh, "a": dh.sum(axis=0), "B": h.T @ dt, "C": h.T @ dg, "v": (f["t"] * f["g"]).T @ de, "u": f["bag"].T @ ds, "c": ds.sum(keepdims=True)}


def _opened(x: bytes, words: bytes, first: bytes) -> Passages:
    features = np.frombuffer(x, np.float32).reshape(-1, FEATURES)
    return Passages(features, np.frombuffer(words, np.int16).reshape(-1, 2), np.frombuffer(first, np.int64), np.array([0, len(features)]))


def held_out() -> Column:
    """Rows that no model learns from: crc32 of the id's text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> AttentionModel:
    """A model of labels.quality from at most `most` documents that are not held out.

    Labels other than 0 and 1 are ignored; several labels of one document count
    as their rounded mean.  Of the rows of a repeated doc_id the least text teaches.
    Which documents teach depends on their ids alone, equal hashes by id; doc_id may
    be of any whole-number type.  With no usable label, as with empty tables, the
    model scores everything 0.5.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg("quality")).cast("int").alias("quality"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            for i, j in slices(offs, 1 << 20):
                bags = encode(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]).rows()
                made = [pa.array([getattr(b, name).tobytes() for b in bags], pa.binary()) for name in ("x", "words", "first")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("quality").slice(i, j - i), *made], ["doc_id", "quality", "x", "words", "first"])

    # at most `most` ids: a bound that does not grow with the tables
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sorted(chosen.mapInArrow(run, "doc_id long, quality int, x binary, words binary, first binary").collect())
    bags = [(_opened(*r[2:]), r[1]) for r in rows if len(r[2])]
    model = AttentionModel()
    if not bags:
        model.p["u"][:] = 0
        return model
    return model.fit([b for b, _ in bags], np.array([y for _, y in bags], np.float32))


def with_scores(docs: DataFrame, model: AttentionModel, name: str = "__score") -> DataFrame:
    """`docs` with the score of each whole text in the column `name`, which must be new; null and empty texts get one too."""
    refuse_clashes(docs, name)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            scores = [own.score(encode(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])) for i, j in slices(offs, 1 << 20)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores or [np.zeros(0)]), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 up) of every row of `docs`.

    A text of any length is read whole.  Null, empty and wordless texts share one
    score; equal texts have equal ones, so repeated rows come out alike.  A null
    doc_id is not held out and teaches nothing.  Other columns are ignored; an empty
    table of documents gives an empty result.
    """
    scored = with_scores(docs.select("doc_id", F.col("text").cast("string").alias("text")), train(docs, labels, most))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
