"""Dictionary tables: colour sheets, ordered substring lookups, one-to-many charts."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import written
from .dedupe import batch_ids

#: Words of a dictionary that is scanned in order within the plan.
MOST_WORDS = 5_000
#: Words of one automaton that every executor gets; a larger dictionary has several.
PART_WORDS = 100_000
#: Automata that a Python worker keeps compiled; a dictionary of more parts is joined.
KEPT = 4
#: Bits of a dictionary's filter for each word, its most bits in all, and the bits of one of its blocks.
BITS, MOST_BITS, BLOCK_BITS = 16, 1 << 29, 1 << 19
#: Characters of texts whose pieces are hashed at once.
PIECES = 1 << 20


def color_lookups(sheet: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(by code, by English name, by Chinese word) of a sheet (pos, code, english, chinese).

    Codes and names are compared in lower case and the last row wins; a Chinese
    word leads to all its codes in sheet order, comma-joined.
    """
    rows = sheet.select("pos", F.trim("code").alias("code"), F.trim("english").alias("english"), F.col("chinese")).where("code <> ''")
    by_code = rows.groupBy(F.lower("code").alias("key")).agg(F.max_by("code", "pos").alias("value"))
    by_name = rows.where("english <> ''").groupBy(F.lower("english").alias("key")).agg(F.max_by("code", "pos").alias("value"))
    words = rows.select("pos", "code", F.posexplode(F.split("chinese", ",")).alias("k", "word"))
    words = words.select("pos", "code", F.replace(F.replace("word", F.lit(" "), F.lit("")), F.lit("Logo"), F.lit("")).alias("key")).where("key <> ''")
    own = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"])
    by_word = words.groupBy("key").agg(F.array_join(F.array_distinct(own), ",").alias("value"))
    return by_code, by_name, by_word


def _probe(df: DataFrame, lookup: DataFrame, key: Column, out: str) -> DataFrame:
    side = lookup.select(F.col("key").alias("_key"), F.col("value").alias(out))
    return df.withColumn("_probe", key).join(side, F.col("_probe") == F.col("_key"), "left").drop("_probe", "_key")


def match_color(df: DataFrame, first: str, second: str, sheet: DataFrame | None, out: str = "_matched") -> DataFrame:
    """A colour by precedence: second word as code, as English name, first word as Chinese word, else the words themselves.

    Without a sheet the first word stands.
    """
    if sheet is None:
        return df.withColumn(out, F.coalesce(F.col(first), F.lit("")))
    by_code, by_name, by_word = color_lookups(sheet)
    low = F.when(F.col(second) != "", F.lower(second))
    found = _probe(_probe(_probe(df, by_code, low, "_c1"), by_name, low, "_c2"), by_word, F.when(F.col(first) != "", F.col(first)), "_c3")
    words = [F.nullif(F.lower(F.trim(F.col(second))), F.lit("")), F.nullif(F.col(first), F.lit(""))]
    return found.withColumn(out, F.coalesce("_c1", "_c2", "_c3", *words, F.lit(""))).drop("_c1", "_c2", "_c3")


def equal_lookup(df: DataFrame, key: str, dictionary: DataFrame, default: Column | None = None, out: str = "value") -> DataFrame:
    """The value of a dictionary (key, value) with one row a key, else `default`; Spark broadcasts it if it is small."""
    found = _probe(df, dictionary, F.col(key), "_value")
    return found.withColumn(out, F.coalesce("_value", default) if default is not None else F.col("_value")).drop("_value")


def _in_automata(text: Column, parts: list[tuple[str, Broadcast]]) -> Column:
    """struct<hit, value> of the first word that a text holds, in Arrow batches; null without one.

    `parts` are (name, words) in the dictionary's order.  A text that has its word in
    one part asks no later one.  A Python worker compiles a part once and keeps the
    last `KEPT` of them.
    """

    @F.pandas_udf("hit boolean, value string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            hit, value = [False] * len(texts), [None] * len(texts)
            left = [(k, t) for k, t in enumerate(texts) if t is not None]
            for name, words in parts:
                if not left:
                    break
                own, empty, held = _compiled(name, words)
                later = []
                for k, t in left:
                    place = min([*([p for _, p in own.iter(t)] if len(own) else []), *([] if empty is None else [empty])], default=None)
                    if place is None:
                        later.append((k, t))
                    else:
                        hit[k], value[k] = True, held[place]
                left = later
            yield pd.DataFrame({"hit": hit, "value": value})

    got = run(text)
    return F.when(got["hit"], got)


_COMPILED: OrderedDict[str, tuple[ahocorasick.Automaton, int | None, list[str | None]]] = OrderedDict()


def _compiled(name: str, words: Broadcast) -> tuple[ahocorasick.Automaton, int | None, list[str | None]]:
    """The automaton of a part, the place of its first empty word, and its values by place."""
    if name not in _COMPILED:
        _COMPILED[name] = (*_automaton(words.value), [v for _, v in words.value])
        while len(_COMPILED) > KEPT:
            _COMPILED.popitem(last=False)
    _COMPILED.move_to_end(name)
    return _COMPILED[name]


def _automaton(words: list[tuple[str, str | None]]) -> tuple[ahocorasick.Automaton, int | None]:
    """The automaton of the words that are not empty, each with its first place, and the place of the first empty one."""
    own, empty = ahocorasick.Automaton(), None
    for k, (word, _) in enumerate(words):
        if not word:
            empty = k if empty is None else empty
        elif word not in own:
            own.add_word(word, k)
    if len(own):
        own.make_automaton()
    return own, empty


_BASE, _MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base % (1 << 64), np.uint64)]))[:n]


def _bit(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    """The k-th place of each hash in a filter of `size` bits, a power of two."""
    x = (hashes ^ (hashes >> np.uint64(29 + k))) * np.uint64(_MIX[k])
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(3)) & np.uint64(size - 1)


def _piece_hashes(codes: np.ndarray, ends: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, hashes) of the pieces of texts that lie behind each other; `ends` is the end of the text of each character."""
    longest = max(lengths)
    for a in range(0, len(codes), PIECES):
        part = codes[a : a + PIECES + longest]
        own = min(PIECES, len(codes) - a)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(len(part), _BASE), dtype=np.uint64)])
        back = _powers(own, pow(_BASE, -1, 1 << 64))
        for n in lengths:
            starts = np.flatnonzero(ends[a : a + own] - np.arange(a, a + own) >= n)
            yield n, starts + a, (sums[starts + n] - sums[starts]) * back[starts]


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of texts behind each other, the end of each one's text, and its number."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.repeat(np.cumsum(sizes), sizes), np.repeat(np.arange(len(texts)), sizes)


def _filter_of(words: DataFrame) -> tuple[list[int], int, Broadcast]:
    """The lengths of the words, and a Bloom filter of them: its bits and its blocks by number."""
    found = words.agg(F.count("*").alias("n"), F.collect_set(F.length("word")).alias("lengths")).first()
    size = min(MOST_BITS, max(BLOCK_BITS, 1 << (BITS * found.n - 1).bit_length()))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [w for w in batch["word"] if w]
            codes, ends, _ = _laid_out(own)
            firsts = np.cumsum([0, *map(len, own)])[:-1]
            hashes = np.zeros(len(own), np.uint64)
            for n, starts, h in _piece_hashes(codes, ends, sorted({len(w) for w in own})) if own else ():
                at = np.searchsorted(firsts, starts).clip(max=len(own) - 1)
                whole = (firsts[at] == starts) & (ends[starts] - starts == n)
                hashes[at[whole]] = h[whole]
            bits = np.unique(np.concatenate([_bit(hashes, k, size) for k in range(len(_MIX))])) if own else np.zeros(0, np.uint64)
            yield pd.DataFrame({"block": (bits // BLOCK_BITS).astype(np.int32), "bit": (bits % BLOCK_BITS).astype(np.int32)})

    def block(key, rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(BLOCK_BITS, np.uint8)
        marks[rows["bit"].to_numpy()] = 1
        return pd.DataFrame({"block": [key[0]], "marks": [np.packbits(marks).tobytes()]})

    blocks = words.select("word").mapInPandas(places, "block int, bit int").groupBy("block").applyInPandas(block, "block int, marks binary")
    held = {r.block: bytes(r.marks) for r in blocks.toLocalIterator()}
    empty = bytes(BLOCK_BITS // 8)
    return sorted(found.lengths), size, words.sparkSession.sparkContext.broadcast(b"".join(held.get(k, empty) for k in range(size // BLOCK_BITS)))


def _joined_words(df: DataFrame, text: str, rows: DataFrame, out: str) -> DataFrame:
    """`first_contained` by a hash join of words with the pieces of each text that are as long as a word and pass the words' filter.

    A text stands for all its copies, by its SHA-256.
    """
    words = written(rows.groupBy("word").agg(F.min(F.struct("pos", "value")).alias("_own")), "dictionary")
    lengths, size, marks = _filter_of(words)

    @F.pandas_udf("array<string>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = np.frombuffer(marks.value, np.uint8)
        for batch in batches:
            texts = list(batch)
            found = [{""} if 0 in lengths else set() for _ in texts]
            codes, ends, numbers = _laid_out(texts)
            begins = np.cumsum([0, *map(len, texts)])
            for n, starts, hashes in _piece_hashes(codes, ends, [n for n in lengths if n]) if any(lengths) else ():
                for k in range(len(_MIX)):
                    at = _bit(hashes, k, size)
                    kept = (held[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
                    starts, hashes = starts[kept], hashes[kept]
                for i in starts:
                    t = numbers[i]
                    found[t].add(texts[t][i - begins[t] : i - begins[t] + n])
            yield pd.Series([sorted(f) for f in found])

    key = F.unhex(F.sha2(text, 256))
    texts = df.select(key.alias("_text_key"), F.col(text).cast("string").alias("_text")).where("_text is not null")
    one = texts.groupBy("_text_key").agg(F.first("_text").alias("_text"))
    asked = one.select("_text_key", F.explode(pieces("_text")).alias("word"))
    first = asked.join(words, "word").groupBy("_text_key").agg(F.min(F.struct("_own.pos", "word", "_own.value")).alias("_found"))
    found = df.withColumn("_probe", key).join(first, F.col("_probe") == F.col("_text_key"), "left")
    return found.withColumn(out, F.col("_found.value")).drop("_probe", "_text_key", "_found")


def first_contained(df: DataFrame, text: str, key: str, dictionary: DataFrame, out: str = "value", most_words: int = MOST_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """The value of the first dictionary row (pos, word, value) whose word the text holds; null words hold nowhere.

    Rows of one pos follow each other by word.  A dictionary of up to `most_words`
    becomes one literal array that is scanned in order: no join, and no pair of rows.
    A larger one is cut along its order into parts of `part_words`; each is sent to
    the executors, which compile it once, and a text goes from part to part until
    one of its words is found.  The driver holds one part at a time.  One of more
    than `KEPT` parts, which a worker could not keep compiled, is joined by its
    words: the work grows with the texts' characters times the distinct lengths of
    words, and only a filter of `BITS` bits a word, `MOST_BITS` at most, is sent.
    """
    spark = df.sparkSession
    rows = dictionary.select("pos", F.col(key).cast("string").alias("word"), F.col("value").cast("string").alias("value")).where("word is not null")
    words = [(r.word, r.value) for r in rows.orderBy("pos", "word").take(most_words + 1)]
    if not words:
        return df.withColumn(out, F.lit(None).cast("string"))
    if len(words) <= most_words:
        entries = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(v).alias("value")) for w, v in words])
        return df.withColumn(out, F.get(F.filter(entries, lambda e: F.col(text).contains(e["word"])), F.lit(0))["value"])
    if rows.count() > KEPT * part_words:
        return _joined_words(df, text, rows, out)
    cut = written(batch_ids(rows, ["pos", "word"], part_words, "part"), "dictionary")
    parts = []
    for k in range(cut.agg(F.max("part")).first()[0] + 1):
        part = [(r.word, r.value) for r in cut.where(F.col("part") == k).orderBy("pos", "word").collect()]
        parts.append((uuid.uuid4().hex, spark.sparkContext.broadcast(part)))
    return df.withColumn(out, _in_automata(F.col(text), parts)["value"])


def multi_value(*charts: DataFrame) -> DataFrame:
    """(key, values): the sorted distinct values of each key over several tables (key, value)."""
    rows = charts[0]
    for c in charts[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy("key").agg(F.sort_array(F.collect_set("value")).alias("values"))
