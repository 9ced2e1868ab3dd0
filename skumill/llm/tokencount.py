"""Exact token counts at every prefix of a text, by dynamic programming.

Within one pre-token the encoding of a prefix is its last token after the
encoding of what comes before that token, and two tokens may stand side by side
exactly if merging their joined bytes gives these two tokens back.  So the last
token at each place is the longest vocabulary entry ending there that may follow
the last token at its own start, and count[place] = count[start] + 1.

A document's counts are kept as one signed byte a character: the change of the
count as that character is added.  Their running sum is the token count of each
prefix, encoded by itself, which answers length, truncation and budget questions
without encoding again.

The vocabulary is a tokenizer file with a byte-level BPE model; its path is a
parameter and it is read on the driver only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_letters, merge_ids
from .common import refuse_clashes
from .textscan import column_bytes, slices

#: How the byte-level vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose steps one worker remembers.
REMEMBER = 400_000
#: Bytes of the pre-tokens kept so, and pairs of tokens judged, before a worker forgets them.
REMEMBER_BYTES, REMEMBER_PAIRS = 64 << 20, 2_000_000


class ByteBPE:
    """Merges and tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.start = [vocab[c] for c in letters]
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.key = hashlib.sha256(json.dumps(spec["model"]["merges"]).encode()).hexdigest()
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}

    def merged(self, raw: bytes) -> list[int]:
        return merge_ids([self.start[b] for b in raw], self.ranks)


class _Known(dict):
    """Steps by pre-token, found on first use."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find, self.size = find, 0

    def __missing__(self, word: str) -> bytes:
        got = self[word] = self.find(word)
        self.size += 4 * len(word) + len(got)
        return got

    def clear(self) -> None:
        super().clear()
        self.size = 0


class PrefixCounter:
    """One worker's tables: a trie of reversed tokens, the pairs judged so far and the pre-tokens seen last."""

    def __init__(self, model: ByteBPE) -> None:
        self.model = model
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, model.specials))) if model.specials else None
        self.trie: dict = {}
        for i, raw in model.bytes_of.items():
            if len(raw) < 3 or model.merged(raw) == [i]:
                node = self.trie
                for b in reversed(raw):
                    node = node.setdefault(b, {})
                node[256] = i
        self.pairs: dict[int, bool] = {}
        self.known = _Known(self.steps_of)

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= REMEMBER_PAIRS:
                self.pairs.clear()
            of = self.model.bytes_of
            ok = self.pairs[key] = self.model.merged(of[a] + of[b]) == [a, b]
        return ok

    def counts(self, raw: bytes) -> list[int]:
        """The token count of every byte prefix of one pre-token."""
        last, count, pairs = [0] * (len(raw) + 1), [0] * (len(raw) + 1), self.pairs
        for j in range(1, len(raw) + 1):
            node, i, ends = self.trie, j, []
            while i:
                node = node.get(raw[i - 1])
                if node is None:
                    break
                i -= 1
                token = node.get(256)
                if token is not None:
                    ends.append((i, token))
            while ends:
                i, token = ends.pop()
                if not i:
                    break
                ok = pairs.get(last[i] << 20 | token)
                if ok if ok is not None else self.fits(last[i], token):
                    break
            last[j], count[j] = token, count[i] + 1
        return count

    def steps_of(self, word: str) -> bytes:
        """The change of the count at each character of a pre-token."""
        raw = word.encode()
        count = self.counts(raw)
        if len(raw) > len(word):
            ends, at = [0], 0
            for c in word:
                at += len(c.encode())
                ends.append(at)
            count = [count[e] for e in ends]
        if len(word) == 3 and word in ("'re", "'ve", "'ll"):
            count[2] = 2  # an apostrophe and one of these letters are two pre-tokens
        return bytes([(b - a) & 255 for a, b in zip(count, count[1:], strict=False)])

    def plain(self, text: str) -> bytes:
        """The steps of a text without special strings."""
        words = self.split(text)
        if len(self.known) >= REMEMBER or self.known.size >= REMEMBER_BYTES:
            self.known.clear()
        steps = b"".join(map(self.known.__getitem__, words))
        if self._gaps(text):
            out, at, total = bytearray(steps), 0, lambda w: int(prefix_counts(self.known[w])[-1])
            for w, then in zip(words, words[1:], strict=False):
                at += len(w)
                # while a run of white space ends the prefix it is one pre-token
                if self._space(w) and self._space(then[0]):
                    fix = total(w + then[0]) - total(w) - total(then[0])
                    out[at] = (out[at] + fix) & 255
                    out[at + 1] = (out[at + 1] - fix) & 255
            steps = bytes(out)
        return steps

    _gaps = staticmethod(regex.compile(r"\s\s").search)
    _space = staticmethod(regex.compile(r"\s+").fullmatch)

    def steps(self, text: str) -> bytes:
        """The change of the token count at each character of a whole text."""
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self.plain(text)
        out, at = [], 0
        for m in found:
            part = text[at : m.end()]
            before = self.plain(part[:-1])
            alone = int(np.frombuffer(self.plain(text[at : m.start()]), np.int8).sum(dtype=np.int64))
            jump = alone + 1 - int(np.frombuffer(before, np.int8).sum(dtype=np.int64))
            out += [before, np.array([jump], np.int8).tobytes()]
            at = m.end()
        return b"".join(out) + self.plain(text[at:])


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, ... characters."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def longest_within(steps: bytes, budget: int) -> int:
    """The characters of the longest prefix of at most `budget` tokens."""
    return int(np.flatnonzero(prefix_counts(steps) <= budget)[-1])


_counters: dict[str, PrefixCounter] = {}


def _counter(sent: Broadcast) -> PrefixCounter:
    """This worker's tables, kept for its next tasks."""
    if sent.value.key not in _counters:
        _counters.clear()
        _counters[sent.value.key] = PrefixCounter(sent.value)
    return _counters[sent.value.key]


def with_prefix_counts(docs: DataFrame, path: str, steps: str = "__steps", total: str = "__n_tokens", fit: str = "__fit", budget: int = 512) -> DataFrame:
    """`docs` with the prefix steps of each whole text (binary), its token count and the characters that `budget` tokens hold.

    A null text counts as empty: no steps, 0 tokens.  The vocabulary's special
    strings in a text are one token each, as the library encodes by default.  Texts of
    any length are counted whole, repeated rows come out alike, an empty table gives
    an empty one, and a column of `docs` named as one of the three added ones raises.
    """
    refuse_clashes(docs, steps, total, fit)
    sent = docs.sparkSession.sparkContext.broadcast(ByteBPE(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counter(sent)
        for batch in batches:
            _, offs = column_bytes(batch.column("text").cast(pa.string()))
            for i, j in slices(offs, 1 << 20):
                some = batch.slice(i, j - i)
                got = [own.steps(t) if t else b"" for t in some.column("text").to_pylist()]
                sums = [int(prefix_counts(s)[-1]) for s in got]
                fits = [len(s) if n <= budget else longest_within(s, budget) for s, n in zip(got, sums, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(got, pa.binary()), pa.array(sums, pa.int64()), pa.array(fits, pa.int64())], [*batch.schema.names, steps, total, fit])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(steps, T.BinaryType()), *[T.StructField(n, T.LongType()) for n in (total, fit)]]))


def within_budget(counted: DataFrame, budget: int, steps: str = "__steps", text: str = "text", out: str = "__within") -> DataFrame:
    """`counted` with the longest prefix of its text that has at most `budget` tokens; only the steps are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [t[: longest_within(s, budget)] if t else t for s, t in zip(batch.column(steps).to_pylist(), batch.column(text).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.string())], [*batch.schema.names, out])

    return counted.mapInArrow(run, T.StructType([*counted.schema.fields, T.StructField(out, T.StringType())]))


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars of every row of `docs`.

    The count is that of the longest prefix; fit_chars is where a text would have
    to be cut to hold `limit` tokens at most, read off the prefix steps.  Other
    columns are ignored, otherwise as `with_prefix_counts`.
    """
    done = with_prefix_counts(docs.select("doc_id", F.col("text").cast("string").alias("text")), path, budget=limit)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return done.select("doc_id", n_bytes.alias("n_bytes"), F.col("__n_tokens").alias("n_tokens"), (F.col("__n_tokens") > limit).alias("over_limit"), F.col("__fit").alias("fit_chars"))
