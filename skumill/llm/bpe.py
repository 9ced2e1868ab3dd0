"""Byte-pair encoding and decoding through a minimal acyclic word transducer.

1. The words of all documents are counted; those that make up at least `share`
   of all words (so at most 1 / share words) are encoded once by merging.
2. They are compiled into a minimal acyclic automaton: sorted insertion with a
   register of equal states, so that words share their endings.  Each transition
   carries the number of words that come before it; the sum along a path is the
   word's number, which leads to its ids.
3. The automaton goes to every executor as one file that its workers map into
   memory.  A batch's distinct words walk through it together; a word it lacks
   is merged exactly.

The vocabulary is a tokenizer file with a BPE model whose words end in a suffix;
its path is a parameter and it is read on the driver only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import struct
import tempfile
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, refuse_clashes, stored
from .textscan import column_bytes, slices

#: Least share of all words that puts a word into the automaton.
SHARE = 1e-6
#: Words whose ids one worker remembers between batches.
REMEMBER = 300_000
_NONE = 1 << 62


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: printable Latin-1 bytes are themselves, the others follow 255 in order."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def merge_ids(ids: list[int], ranks: dict[int, int]) -> list[int]:
    """Apply merges in rank order, leftmost first; ranks: (a << 20 | b) -> (rank << 20 | merged id)."""
    if len(ids) > 400:
        return _merge_long(ids, ranks)
    get = ranks.get
    near = [get(a << 20 | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
    while near:
        low = min(near)
        if low == _NONE:
            break
        p = near.index(low)
        ids[p] = low & 0xFFFFF
        del ids[p + 1], near[p]
        if p < len(near):
            near[p] = get(ids[p] << 20 | ids[p + 1], _NONE)
        if p:
            near[p - 1] = get(ids[p - 1] << 20 | ids[p], _NONE)
    return ids


def _merge_long(ids: list[int], ranks: dict[int, int]) -> list[int]:
    """The same with a heap and a linked list, for words of any length."""
    n = len(ids)
    after, before, live = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(ids[i] << 20 | ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i] if live[i] else n
        if j >= n or ranks.get(ids[i] << 20 | ids[j]) != r:
            continue
        ids[i], live[j], after[i] = r & 0xFFFFF, False, after[j]
        if after[j] < n:
            before[after[j]] = i
            if (s := ranks.get(ids[i] << 20 | ids[after[j]])) is not None:
                heapq.heappush(heap, (s, i))
        if before[i] >= 0 and (s := ranks.get(ids[before[i]] << 20 | ids[i])) is not None:
            heapq.heappush(heap, (s, before[i]))
    return [x for x, on in zip(ids, live, strict=True) if on]


class WordBPE:
    """What encoding needs of a tokenizer file: word pattern, special strings, start ids of bytes, merges and token texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + suffix] for c in letters]
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.tokens = [""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token

    def prepare(self) -> WordBPE:
        self.words: Callable[[str], list[str]] = regex.compile(self.pattern).findall
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        return self

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "special")}

    def ids_of(self, word: str) -> list[int]:
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        return merge_ids(ids, self.ranks)

    def split(self, text: str) -> list[str]:
        """The words of a text without special strings: NFC, then lower case character by character."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # str.lower() has a rule for a final sigma
        return self.words(text.lower())

    def pieces(self, text: str) -> list[str | int]:
        """The words of a text and the ids of the special strings in it, in order."""
        if self.special is None or "<" not in text:
            return self.split(text)
        out: list[str | int] = []
        at = 0
        for m in self.special.finditer(text):
            out += self.split(text[at : m.start()])
            out.append(self.specials[m[0]])
            at = m.end()
        return out + self.split(text[at:])


# --- the automaton -----------------------------------------------------------


def compile_words(words: list[bytes], outputs: list[bytes]) -> bytes:
    """A minimal acyclic automaton of sorted distinct non-empty words, with an output each, as one file image.

    A state is written out as soon as no later word can change it, targets before
    the states that lead to them; only the states of the last word are kept open.
    """
    keys, targets, skips, finals, below = (array(kind) for kind in "IIIBI")
    register: dict[bytes, int] = {}  # a settled state's final flag and arcs: its number
    chain: list[tuple[bytearray, array]] = [(bytearray(1), array("I"))]  # final flag and labels, targets

    def number_of(state: tuple[bytearray, array]) -> int:
        head, out = state
        key = bytes(head) + out.tobytes()
        me = register.setdefault(key, len(finals))
        if me == len(finals):
            count = head[0]
            for b, t in zip(head[1:], out, strict=True):
                keys.append(me << 8 | b)
                targets.append(t)
                skips.append(count)
                count += below[t]
            finals.append(head[0])
            below.append(count)
        return me

    def settle(depth: int) -> None:
        while len(chain) - 1 > depth:
            done = number_of(chain.pop())
            chain[-1][1].append(done)

    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        settle(same)
        for b in word[same:]:
            chain[-1][0].append(b)
            chain.append((bytearray(1), array("I")))
        chain[-1][0][0] = 1
        last = word
    settle(0)
    root = number_of(chain[0])
    del register
    arrays = {
        "keys": np.array(keys, np.uint32),
        "targets": np.array(targets, np.uint32),
        "skips": np.array(skips, np.uint32),
        "finals": np.array(finals, np.uint8),
        "root": np.array([root], np.uint32),
        "at": np.concatenate([[0], np.cumsum([len(x) for x in outputs])]).astype(np.uint32),
        "out": np.frombuffer(b"".join(outputs), np.uint8),
    }
    head, at = {}, 0
    for k, v in arrays.items():
        head[k] = (at, len(v), str(v.dtype))
        at += -(-v.nbytes // 8) * 8
    top = json.dumps(head).encode()
    top += b" " * (-(len(top) + 8) % 8)
    return struct.pack("<q", len(top)) + top + b"".join(v.tobytes() + b"\0" * (-v.nbytes % 8) for v in arrays.values())


class Automaton:
    """The mapped file image of `compile_words`."""

    def __init__(self, image: bytes, sha: str) -> None:
        self.sha = sha
        # a file without a name, gone with this worker, so that the pages of the lexicon can be dropped and read again
        with tempfile.TemporaryFile() as f:
            f.write(image)
            f.flush()
            raw = np.memmap(f, dtype=np.uint8, mode="r")
        size = struct.unpack("<q", raw[:8].tobytes())[0]
        for k, (at, n, kind) in json.loads(raw[8 : 8 + size].tobytes()).items():
            width = np.dtype(kind).itemsize
            setattr(self, k, raw[8 + size + at : 8 + size + at + n * width].view(kind))

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The output of each word; None for a word that it lacks."""
        out: list[bytes | None] = [None] * len(words)
        if not len(self.keys) or not words:
            return out
        lens = np.array([len(w) for w in words])
        for some in (np.flatnonzero(lens <= 24), np.flatnonzero((lens > 24) & (lens <= 255))):
            if not len(some):
                continue
            width = int(lens[some].max())
            grid = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in some.tolist()), np.uint8).reshape(-1, width)
            live, size = np.arange(len(some)), lens[some]
            state = np.full(len(some), self.root[0], np.uint32)
            number = np.zeros(len(some), np.int64)
            for p in range(width):
                live = live[size[live] > p]
                key = state[live] << np.uint32(8) | grid[live, p]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[place] == key
                lost, live, place = live[~ok], live[ok], place[ok]
                size[lost] = -1
                number[live] += self.skips[place]
                state[live] = self.targets[place]
            hit = np.flatnonzero((size >= 0) & (self.finals[state] > 0))
            body = memoryview(self.out)
            for i, a, b in zip(some[hit].tolist(), self.at[number[hit]].tolist(), self.at[number[hit] + 1].tolist(), strict=True):
                out[i] = bytes(body[a:b])
        return out


# --- Spark jobs --------------------------------------------------------------


def word_counts(docs: DataFrame, model: WordBPE) -> DataFrame:
    """(word, n) over the whole texts of all documents, counted in each task before the shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def flush(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, c = sent.value.prepare(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    c.update(p for p in own.pieces(text) if p.__class__ is str) if "<|" in text else c.update(own.split(text))
                if len(c) > 400_000:
                    yield flush(c)
                    c = Counter()
        yield flush(c)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, model: WordBPE, share: float = SHARE) -> bytes:
    """The automaton of the words that make up at least `share` of all words: 1 / share of them at most.

    The words are merged in tasks; the driver gets those of 60 characters at most with
    their ids and compiles them.  A million random words took it 200 MB.
    """
    counts = stored(word_counts(docs, model), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words], pa.binary()), pa.array([np.array(own.ids_of(w), "<u4").tobytes() for w in words], pa.binary())], ["word", "ids"])

    frequent = counts.where((F.col("n") >= F.lit(share * total)) & (F.length("word") <= 60)).select("word").mapInArrow(merged, "word binary, ids binary").toArrow().sort_by("word")
    discard(counts)
    return compile_words(frequent["word"].to_pylist(), frequent["ids"].to_pylist())


class _Encoder:
    """One worker's encoder: the automaton, exact merging of the rest, and the words seen last."""

    def __init__(self, model: WordBPE, image: bytes, sha: str) -> None:
        self.model, self.automaton = model.prepare(), Automaton(image, sha)
        self.known: dict[str | int, bytes] = {}

    def learn(self, words: set) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            new = list(words)
        ids = self.model.ids_of
        plain = [w for w in new if w.__class__ is str]
        self.known.update((w, struct.pack("<I", w)) for w in new if w.__class__ is not str)
        for w, found in zip(plain, self.automaton.find([w.encode() for w in plain]), strict=True):
            self.known[w] = np.array(ids(w), "<u4").tobytes() if found is None else found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self.model.pieces(t) if t else [] for t in texts]
        self.learn(set().union(*pieces))
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


_encoders: dict[str, _Encoder] = {}


def _encoder(model: WordBPE, image: bytes, sha: str) -> _Encoder:
    """This worker's encoder, kept for its next tasks."""
    if sha not in _encoders:
        _encoders.clear()
        _encoders[sha] = _Encoder(model, image, sha)
    return _encoders[sha]


def encode(docs: DataFrame, path: str, share: float = SHARE, decoded: bool = True, ids: str = "__ids", text: str = "__decoded") -> DataFrame:
    """`docs` with its texts' ids (little-endian unsigned 32-bit integers, as binary) and the text they decode to.

    Ids are those of the vocabulary's own encoding without added special tokens;
    its special strings in a text become their ids.  A null text counts as
    empty, and an empty one has no ids and decodes to an empty text.  Every row is
    encoded for itself, repeated ones alike; a text of any length is encoded whole.
    An empty table gives an empty result.  A column of `docs` named as one of the
    added ones raises.
    """
    refuse_clashes(docs, *([ids, text] if decoded else [ids]))
    spark = docs.sparkSession
    model = WordBPE(path)
    image = lexicon(docs.select("text"), model, share)
    sent = spark.sparkContext.broadcast((model, image, hashlib.sha256(image + path.encode()).hexdigest()[:20]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(*sent.value)
        for batch in batches:
            _, offs = column_bytes(batch.column("text").cast(pa.string()))
            for i, j in slices(offs, 1 << 20):
                some = batch.slice(i, j - i)
                got = own.encode(some.column("text").to_pylist())
                cols = [pa.array(got, pa.binary())] + ([pa.array([decode_ids(x, own.model.tokens) for x in got], pa.string())] if decoded else [])
                yield pa.RecordBatch.from_arrays([*some.columns, *cols], [*batch.schema.names, ids] + [text] * decoded)

    fields = [T.StructField(ids, T.BinaryType())] + [T.StructField(text, T.StringType())] * decoded
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def decode_ids(ids: bytes, tokens: list[str]) -> str:
    """The text of ids: the vocabulary has no decoder, so its tokens stand side by side with a space between."""
    return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(df: DataFrame, path: str, ids: str = "__ids", text: str = "__decoded") -> DataFrame:
    """`df` with the text that its ids decode to; null ids give an empty text."""
    sent = df.sparkSession.sparkContext.broadcast(WordBPE(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array([decode_ids(x or b"", sent.value) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], [*batch.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))


def round_trip_digests(docs: DataFrame, path: str, share: float = SHARE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of `docs`; other columns are ignored, otherwise as `encode`."""
    done = encode(docs.select("doc_id", F.col("text").cast("string").alias("text")), path, share)
    return done.select(
        "doc_id",
        F.floor(F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("__ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("__decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
