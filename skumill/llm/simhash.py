"""SimHash near-duplicate components by meet-in-the-middle ball hashing.

A document's shingles are runs of three words, repeats included; a bit of its
64-bit fingerprint is set where over half of the shingles' XXH64 values have it.
Documents whose fingerprints differ in at most three bits are linked; a component
is what links connect.

Two fingerprints at most three bits apart have a word between them that each
reaches with half of the flips, one or two.  Every distinct fingerprint emits the
words around it, and those that meet on one word are compared:

* all emit themselves and the 64 words one flip away: distances up to 2 meet;
* at distance 3 one of the two has an odd number of set bits.  Those also emit
  words two flips away.  Of three bits, two are of one parity of position, so flips
  of two bits of one parity are enough: 992 words, and the other flips the third.

Whoever needs one flip at most is within three bits of all that meet there, so the
smallest of these is linked with each: a forest, not the pairs.  At most 1057 words
come from a fingerprint and at most as many fingerprints meet on a word, however
large a group of copies is.

Words are not shuffled one by one.  All words with the same first bits belong to one
group, and a fingerprint is sent once to each group that its words fall in; the rest
of the words is made inside the group.  Groups of more than `group_rows` rows are
split by further bits, down to single words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, spread_join, stored
from .neardup import _forest
from .textscan import LOWER, NON_SPACE, column_bytes, slices, word_spans

SHINGLE = 3
SEED = 42
#: Rows of one group, a few hundred words each at most.
GROUP_ROWS = 4096
#: Bits by which a large group is split.
STEP = 6
#: Shingles whose bits are counted in one numpy pass.
PASS = 1 << 16
#: Bytes from which a shingle is hashed by itself.
LONG = 160
#: Words made before a task looks for those that meet.
MADE = 1 << 21

_U = np.uint64
#: The five multipliers of XXH64; fixed values.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
#: The bits of even places.
EVEN_PLACES = 0x5555555555555555


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _U(P2), 31) * _U(P1)


def _same_length(words: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """XXH64 of the n bytes from each of `at`; words[p] are the eight bytes from p."""
    if n >= 32:
        v = [np.full(len(at), (seed + x) % 2**64, dtype=_U) for x in (P1 + P2, P2, 0, -P1)]
        for _ in range(n // 32):
            v = [_round(x, words[at + 8 * k]) for k, x in enumerate(v)]
            at = at + 32
        h = sum((_rotl(x, k) for x, k in zip(v[1:], (7, 12, 18), strict=True)), _rotl(v[0], 1))
        for x in v:
            h = (h ^ _round(np.zeros_like(x), x)) * _U(P1) + _U(P4)
    else:
        h = np.full(len(at), (seed + P5) % 2**64, dtype=_U)
    h = h + _U(n)
    for _ in range(n % 32 // 8):
        h = _rotl(h ^ _round(np.zeros_like(h), words[at]), 27) * _U(P1) + _U(P4)
        at = at + 8
    if n % 8 >= 4:
        h = _rotl(h ^ (words[at] & _U(0xFFFFFFFF)) * _U(P1), 23) * _U(P2) + _U(P3)
        at = at + 4
    for k in range(n % 4):
        h = _rotl(h ^ (words[at + k] & _U(0xFF)) * _U(P5), 11) * _U(P1)
    h = (h ^ (h >> _U(33))) * _U(P2)
    h = (h ^ (h >> _U(29))) * _U(P3)
    return h ^ (h >> _U(32))


def xxh64_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of buf[start:end] for each span; spans of one length are hashed together."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    lens = ends - starts
    out = np.empty(len(starts), dtype=_U)
    if not len(starts):
        return out
    order = np.argsort(lens, kind="stable")
    sizes, first = np.unique(lens[order], return_index=True)
    for n, a, b in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        at = order[a:b]
        if n < LONG:
            out[at] = _same_length(words, starts[at], n, seed)
        else:
            out[at] = [xxhash.xxh64_intdigest(buf[p : p + n].tobytes(), seed) for p in starts[at].tolist()]
    return out


def _single_spaced(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other with a space behind each, and their new starts and ends."""
    lens = ends - starts
    at = np.concatenate([[0], np.cumsum(lens + 1)])
    out = np.full(int(at[-1]), 32, dtype=np.uint8)
    from_, to = np.repeat(starts - at[:-1], lens), np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)
    out[to] = low[to + from_]
    return out, at[:-1], at[:-1] + lens


def fingerprints(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each row; zero without words."""
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, NON_SPACE)
    text, starts, ends = _single_spaced(low, starts, ends)
    words = np.diff(bounds)
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    upto = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(words)), count)
    first = np.arange(int(upto[-1])) - upto[row] + bounds[row]
    last = first + np.minimum(words, k)[row] - 1
    ones = np.zeros((len(words), 64), dtype=np.int64)
    for i in range(0, len(row), PASS):
        own = slice(i, min(i + PASS, len(row)))
        a, b = starts[first[own]], ends[last[own]]
        base = int(a[0])
        h = xxh64_spans(text[base : int(b[-1])], a - base, b - base)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows, at = np.unique(row[own], return_index=True)
        ones[rows] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row of `docs`; fp holds the 64 bits of the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = column_bytes(batch.column("text"))
            for i, j in slices(offs, 1 << 20):
                fp = fingerprints(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _flips(places: range) -> list[int]:
    """No flip, one flip, and two flips of one parity, among `places`."""
    one = [1 << p for p in places]
    return [0, *one, *(1 << p | 1 << q for p in places for q in range(p + 2, places.stop, 2))]


def _reachable(fp: Column, word: Column, bits: int) -> Column:
    """Whether the first `bits` of `word` can begin a word that `fp` emits."""
    flipped = F.lit(_signed((1 << bits) - 1)).bitwiseAND(fp.bitwiseXOR(word))
    of_even = F.bit_count(flipped.bitwiseAND(F.lit(EVEN_PLACES)))
    return (F.bit_count(flipped) <= 1) | ((F.bit_count(flipped) == 2) & (of_even != 1) & (F.bit_count(fp) % 2 == 1))


def _begun(rows: DataFrame, bits: int, upto: int) -> DataFrame:
    """Rows (fp, word), whose word is settled in its first `bits`, for every way to settle the bits before `upto`."""
    masks = F.array(*[F.lit(_signed(m)) for m in _flips(range(bits, upto))])
    more = rows.select("fp", "word", F.explode(masks).alias("mask"))
    return more.select("fp", F.col("word").bitwiseXOR(F.col("mask")).alias("word")).where(_reachable(F.col("fp"), F.col("word"), upto))


def _met(fp: np.ndarray, word: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges among the fingerprints that meet on a word; `word` is settled in its first `bits`."""
    own, at = np.unique(fp, return_inverse=True)
    whole, who = [], []
    for b in np.unique(bits).tolist():
        mine = np.flatnonzero(bits == b)
        used = np.bitwise_count(fp[mine] ^ word[mine])
        odd = np.bitwise_count(fp[mine]) % 2 == 1
        masks = np.array(_flips(range(b, 64)), dtype=_U)
        flips = np.bitwise_count(masks)
        whole.append(word[mine])
        who.append(mine)
        more = mine[used == 0]
        whole.append((word[more][:, None] ^ masks[flips == 1]).ravel())
        who.append(np.repeat(more, int((flips == 1).sum())))
        more = mine[(used == 0) & odd]
        whole.append((word[more][:, None] ^ masks[flips == 2]).ravel())
        who.append(np.repeat(more, int((flips == 2).sum())))
        for even in (True, False):  # one flip of the parity that the first one had
            places = np.array([1 << p for p in range(b, 64) if (p % 2 == 0) == even], dtype=_U)
            more = mine[(used == 1) & odd & (((fp[mine] ^ word[mine]) & _U(EVEN_PLACES) != 0) == even)]
            whole.append((word[more][:, None] ^ places).ravel())
            who.append(np.repeat(more, len(places)))
    whole, who = np.concatenate(whole), np.concatenate(who)
    order = np.argsort(whole, kind="stable")
    whole, who = whole[order], who[order]
    shared = np.zeros(len(whole), dtype=bool)
    same = whole[1:] == whole[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    whole, who = whole[shared], who[shared]
    near = np.bitwise_count(whole ^ fp[who]) <= 1
    order = np.lexsort((fp[who], ~near, whole))
    whole, who, near = whole[order], who[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(whole) else np.zeros(0, np.int64)
    hub = np.repeat(first, np.diff([*first.tolist(), len(whole)]))
    a, b = who[hub], who
    true = near[hub] & (fp[a] != fp[b]) & (np.bitwise_count(fp[a] ^ fp[b]) <= 3)
    label = _forest(len(own), at[a[true]], at[b[true]])
    linked = np.flatnonzero(label != np.arange(len(own)))
    return own[linked], own[label[linked]]


def ball_edges(fps: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pairs (u, v) that connect the distinct fingerprints `fps` (fp) as all links of three bits at most do; a pair may stand for several links in a row."""
    total = fps.count()
    bits = 0
    # a fingerprint goes to 1 + bits + bits * (bits - 2) / 8 groups or so
    while bits < 24 and total * (1 + bits + bits * bits / 8) > group_rows << bits:
        bits += 1
    rows, ready = _begun(fps.select("fp", F.col("fp").alias("word")), 0, bits), []
    place = lambda b: F.lit(_signed((1 << b) - 1)).bitwiseAND(F.col("word")).alias("place")
    rows, written = stored(rows, "begun"), []
    while True:
        written.append(rows)
        sizes = rows.groupBy(place(bits)).agg(F.count("*").alias("n")).where(F.col("n") > group_rows)
        large = stored(sizes, "large") if bits < 64 else None
        many = large.count() if large is not None else 0
        if not many:
            ready.append(rows.select("fp", "word", F.lit(bits).alias("bits"), place(bits)))
            break
        placed = rows.withColumn("place", place(bits))
        both = spread_join(placed, large, "place", F.col("fp"), "left")
        both = stored(both.select("fp", "word", F.col("n").isNotNull().alias("large")), "parted")
        discard(large)
        written.append(both)
        ready.append(both.where("not large").select("fp", "word", F.lit(bits).alias("bits"), place(bits)))
        rows = stored(_begun(both.where("large").select("fp", "word"), bits, min(64, bits + STEP)), "begun")
        bits = min(64, bits + STEP)
    groups = ready[0]
    for more in ready[1:]:
        groups = groups.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush(upto: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            fp, word, b = (np.concatenate(c) for c in zip(*upto, strict=True))
            u, v = _met(fp.view(_U), word.view(_U), b)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            fp, word, b, place = (batch.column(k).to_numpy() for k in range(4))
            if not len(fp):
                continue
            for i in range(0, len(fp), 1024):
                own = slice(i, i + 1024)
                held.append((fp[own], word[own], b[own], place[own]))
                size += len(fp[own]) * 562
                if size < MADE:
                    continue
                # the last group may go on in the next rows: it waits
                rows = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                going_on = (rows[2] == rows[2][-1]) & (rows[3] == rows[3][-1])
                if not going_on.all():
                    yield flush([tuple(c[~going_on] for c in rows[:3])])
                held = [tuple(c[going_on] for c in rows)]
                size = int(going_on.sum()) * 562 - MADE * going_on.all()
        if held:
            yield flush([h[:3] for h in held])

    dealt = groups.repartition("bits", "place").sortWithinPartitions("bits", "place")
    edges = stored(dealt.mapInArrow(run, "u long, v long"), "links")
    for df in written:
        discard(df)
    return edges


def simhash_duplicates(docs: DataFrame, k: int = SHINGLE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 lowercase hex digits), component_id, kept.

    component_id is the smallest doc_id that links reach, the document itself
    included; kept says that it is this document.  Words end at ASCII white space
    and A-Z counts as a-z; a text of fewer than k words is one shingle; a null or
    wordless text has fingerprint zero and is linked like any other.  Repeated rows
    and the texts of a repeated doc_id are documents of their own.  A row without
    doc_id takes part in links but names no component: where no linked row has an
    id, component_id is null.  Other columns are ignored.  An empty table gives an
    empty result.
    """
    rows = stored(with_fingerprints(docs, k), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("own")), "classes")
    edges = ball_edges(classes, group_rows)
    found = stored(components(edges), "components")
    discard(edges)
    led = found.join(classes.withColumnRenamed("fp", "node"), "node")
    leads = led.groupBy("component").agg(F.min("own").alias("lead"))
    leads = spread_join(found, leads, "component", F.col("node")).select(F.col("node").alias("fp"), "lead")
    named = stored(classes.join(leads, "fp", "left").select("fp", F.coalesce("lead", "own").alias("component_id")), "named")
    discard(found)
    out = spread_join(rows, named, "fp", F.coalesce("doc_id", F.xxhash64("doc_id")))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
