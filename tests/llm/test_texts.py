"""Operators on texts against the libraries they must agree with, or brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skumill.llm import bpe, decontam, neardup, quality, tokencount
from skumill.llm.neardup import HASHES, UNSEEN, _forest, bands_for, least_matches, near_duplicates, shingle_sets, signatures_of
from skumill.llm.textscan import LOWER, NON_SPACE, WORD, span_hashes, word_spans

PIECES = ["a", "B", "é", "é", " ", "  ", "\n", "\t", "'s", "'LL", "'re", "'ve", "'", "<|endoftext|>", "<|startoftext|>", "<|", "Σ", "ΑΣ ", "İ", "ß", "中文", "日本", "１", "½", " ", "　", "\x1c", "🙂", "👍🏽", "!!", "...", "_", "x" * 450, "ab" * 40, "ﬁ", "123", "\x00", "the", "ing", " the", "    "]


def texts(n=250, most=12, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


def docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "'x' AS n_words", "1 AS cluster", "array(1) AS size", "'y' AS label") if extra else df


def test_words_and_hashes_follow_the_bytes():
    sample = ["", "a  b\tA b", "ü-x 9", "x" * 3_000_000 + " y"]
    raw = [t.encode() for t in sample]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    low = LOWER[buf]
    starts, ends, bounds = word_spans(low, offs, NON_SPACE)
    words = [low[a:b].tobytes() for a, b in zip(starts, ends)]
    assert words[:4] == [b"a", b"b", b"a", b"b"] and bounds.tolist() == [0, 0, 4, 6, 8]
    h = span_hashes(low, starts, ends)
    assert h[0] == h[2] and h[1] == h[3] and len({*h.tolist()}) == len({*words})
    starts, ends, _ = word_spans(low, offs, WORD)
    assert [low[a:b].tobytes().decode() for a, b in zip(starts, ends)][4:7] == ["ü", "x", "9"]


def test_encoding_agrees_with_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [*enumerate([*texts(), "", "the " * 3000]), (999, None), (None, "the"), (3, "again")]
    got = bpe.encode(docs(spark, rows, extra=True), path).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["__ids"]), "<u4").tolist() == ids
        assert r["__decoded"] == library.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs(spark, rows), path, decoded=False), path).collect()
    assert {r["__decoded"] for r in again} == {r["__decoded"] for r in got}
    assert bpe.round_trip_digests(docs(spark, []), path).count() == 0


def test_automaton_is_minimal_and_exact():
    words = sorted({w.encode() for w in ("walk", "walks", "walked", "talk", "talks", "talked", "é", "a" * 60)})
    image = bpe.compile_words(words, [w[::-1] for w in words])
    a = bpe.Automaton(image, hashlib.sha256(image).hexdigest())
    assert a.find([*words, b"walke", b"", b"zz", b"talkss", b"a" * 300]) == [*(w[::-1] for w in words), *[None] * 5]
    # walk- and talk- share their endings: one chain behind the first letters
    assert len(a.finals) < 60 + 10


def test_every_prefix_counts_as_the_library_counts_it(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    counter = tokencount.PrefixCounter(tokencount.ByteBPE(path))
    for t in texts(200, 6, 7):
        t = t[:120]
        steps = counter.steps(t)
        assert tokencount.prefix_counts(steps).tolist() == [count(t[:i]) for i in range(len(t) + 1)], repr(t)
        cut = tokencount.longest_within(steps, 5)
        assert count(t[:cut]) <= 5 and all(count(t[:i]) > 5 for i in range(cut + 1, len(t) + 1))
    rows = [(1, None), (2, ""), (3, "word " * 600), (3, "ü"), (None, "x")]
    got = {(r.doc_id, r.n_bytes): r for r in tokencount.token_counts(docs(spark, rows, extra=True), path).collect()}
    assert got[1, 0].n_tokens == got[2, 0].n_tokens == 0 and got[3, 3000].over_limit and not got[3, 2].over_limit and len(got) == 5
    short = tokencount.within_budget(tokencount.with_prefix_counts(docs(spark, rows), path), 3).collect()
    assert {r["__within"] for r in short} >= {None, "", "word word word"}


def test_contamination_against_plain_python(spark):
    rng = random.Random(5)
    vocab = ["Alpha", "beta", "GAMMA", "délta", "e5", "zeta"]
    passage = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, passage(25)), (2, "Only three-words"), (3, None), (4, "..."), (None, passage(12)), (1, passage(14)), (7, passage(10))]
    rows = [(i, passage(30) + ". " + (rng.choice(items)[1] or "").upper() + "! " + passage(15)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "only\nTHREE, words"), (52, "repeated id"), (None, items[0][1]), (54, "," * 50)]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for doc_id, text in rows:
        w, hit, own = words(text), set(), set()
        for item, t in items:
            v = words(t)
            k = min(10, len(v))
            for p in range(len(v) - k + 1 if k else 0):
                for q in range(len(w) - k + 1):
                    if w[q : q + k] == v[p : p + k]:
                        hit.update(range(q, q + k))
                        own.add("null" if item is None else str(item))
        want.append((doc_id, len(w), len(hit), len(own), decontam.sha256_of_items([*own]), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for part_bytes in (1 << 20, 200):  # one scan, and one for each part of the benchmark
        got = [tuple(r) for r in decontam.contamination(docs(spark, rows, extra=True), bench, part_bytes=part_bytes).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert decontam.contamination(docs(spark, rows), bench.limit(0)).where("contaminated").count() == 0
    kept = decontam.without_benchmark(docs(spark, rows, extra=True), bench)
    assert kept.columns == docs(spark, rows, extra=True).columns and kept.count() == sum(not w[5] for w in want)
    cut = decontam.without_benchmark(docs(spark, rows), bench, remove="spans")
    assert cut.count() == len(rows)
    assert decontam.contamination(cut.where("doc_id = 52"), bench).where("contaminated").count() == 0


def _components(rows, percent=85):
    sets = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((d, len(s), root(d), d == root(d)) for d, s in sets)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice((6, 40, 120)))) for _ in range(25)]
    rows = []
    for k in range(160):
        w = rng.choice(base).split()
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9999)}"
        rows.append((k, " ".join(w).upper() if k % 3 else "\n".join(w)))
    hub = " ".join(f"h{i}" for i in range(200)).split()
    for k in range(300, 700):  # more copies than one block holds, each far from most others
        w = list(hub)
        for _ in range(4):
            w[rng.randrange(200)] = f"m{rng.randrange(99999)}"
        rows.append((k, " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE  two"), (905, "one two three")]
    got = sorted(tuple(r) for r in near_duplicates(docs(spark, rows, extra=True)).collect())
    assert got == _components(rows)


def test_pipeline_stage_against_all_pairs(spark):
    rng = random.Random(13)
    rows = []
    for k in range(40):
        w = [f"w{rng.randrange(9999)}" for _ in range(200)]
        rows.append((10 * k, " ".join(w)))
        for j in range(1, 4):  # 3, 4 or 5 words apart: similarities of about 0.86, 0.81 and 0.77
            v = list(w)
            for at in rng.sample(range(8, 190, 6), j + 2):
                v[at] = f"n{rng.randrange(99999)}"
            rows.append((10 * k + j, " ".join(v)))
    want = [d for d, _, _, kept in _components(rows, 80) if kept]
    assert len(want) < sum(kept for *_, kept in _components(rows))
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate(spark, docs(spark, rows, extra=True), "").collect()) == want


def test_every_text_of_a_repeated_id_is_compared(spark):
    word = lambda n, k: [f"{n}{i}" if i not in k else f"x{n}{i}" for i in range(200)]
    rows = [(j, " ".join(word(f"t{j}_{k}_", ()))) for j in range(6) for k in range(3)]
    rows += [(100 + 10 * j + k, " ".join(word(f"t{j}_{k}_", (60, 150)))) for j in range(6) for k in range(3)]
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == {j: (j, True) for j in range(6)} | {100 + 10 * j + k: (j, False) for j in range(6) for k in range(3)}


def test_forest_is_a_full_union():
    assert _forest(6, np.array([1, 3, 4]), np.array([4, 5, 5])).tolist() == [0, 1, 2, 1, 1, 1]
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(2, 40))
        i, j = rng.integers(0, n, (2, int(rng.integers(0, n))))
        want = list(range(n))
        for _ in range(n):
            for a, b in zip(i.tolist(), j.tolist()):
                want[a] = want[b] = min(want[a], want[b])
        assert _forest(n, i, j).tolist() == want


def test_bands_follow_the_threshold():
    assert bands_for(85) == (32, 6)
    for percent in range(10, 100):
        bands, width = bands_for(percent)
        assert bands * width <= HASHES and (1 - (percent / 100) ** width) ** bands <= UNSEEN


def test_near_duplicates_odd_tables(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    text = "a b c d e f g h"
    got = near_duplicates(docs(spark, [(None, text), (4, text), (4, text), (2, text), (2, "other words here")])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted([(None, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (2, 2, True)], key=repr)


def test_pruning_keeps_what_may_reach_the_threshold():
    table = dict(least_matches())
    assert 0.5 * 32 < table[32] + 12 and table[HASHES] < 0.85 * HASHES
    rng = np.random.default_rng(3)
    for share in (0.85, 0.9):  # pairs at and over the threshold survive every look
        for _ in range(300):
            same = rng.random(HASHES) < share
            assert all(same[:n].sum() >= least for n, least in table.items())
    raw = b"a b c d e f"
    assert (signatures_of(shingle_sets(np.frombuffer(raw + b"", np.uint8), np.array([0, len(raw), len(raw)])))[1] == 0xFFFFFFFF).all()


def test_quality_learns_held_out_labels(spark):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choice("etaoinshrd") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 150))) + "."
    rows, labels = [], []
    for k in range(400):
        text = good()
        if k % 2:
            w = text.split()
            at = rng.randrange(len(w))
            text = " ".join([*w[:at], *(x + "***" for x in w[at:])]) if k % 4 == 1 else " | ".join(w)
        rows.append((k, text))
        labels.append((k, 1 - k % 2, 0))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "x" * 300_000), (None, "no id")]
    labels += [(5, 7, 0), (None, 1, 0), (6, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_scores(docs(spark, rows, extra=True), table).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(got[k].predicted, 1 - k % 2) for k in range(400) if got[k].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    none = quality.quality_scores(docs(spark, rows[:3]), table.limit(0)).collect()
    assert {round(r.score, 3) for r in none} == {0.5}
    assert quality.quality_scores(docs(spark, []), table).count() == 0


def test_texts_of_one_id_keep_their_own_links(spark):
    word = lambda n, k=(): " ".join(f"{n}{i}" if i not in k else f"x{n}{i}" for i in range(200))
    rows = [(1, word("a")), (1, word("b")), (2, word("a", (60,))), (3, word("b", (60,))), (4, word("c")), (3, word("d")), (5, word("d", (9,))), (1, word("a"))]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs(spark, rows)).collect())
    assert got == [(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (3, 3, True), (4, 4, True), (5, 3, False)]
    left = corpus_pipeline.near_duplicate(spark, docs(spark, rows, extra=True), "")
    assert left.columns == docs(spark, rows, extra=True).columns
    assert sorted((r.doc_id, r.text[:1]) for r in left.collect()) == [(1, "a"), (1, "a"), (1, "b"), (3, "d"), (4, "c")]
    near = [(1, word("a")), (1, word("a", (3,))), (1, word("a").upper())]
    assert corpus_pipeline.near_duplicate(spark, docs(spark, near), "").count() == 1


def test_benchmark_set_is_arrays_within_its_bound(spark):
    rng = random.Random(6)
    items = [(str(k), " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice((4, 30, 200))))) for k in range(300)]
    built = decontam.item_windows(items)
    words = sum(len(t.split()) for _, t in items)
    assert built.nbytes() <= sum(len(t) for _, t in items) + words * decontam.WORD_BYTES
    assert all((w.keys[1:] >= w.keys[:-1]).all() for w in built.by_length.values())
    # a null id is an item of its own, beside one that is called so
    bench = spark.createDataFrame([(None, "one two three"), ("null", "three four"), ("a", "one two three")], "item_id string, text string")
    rows = [(1, "x one two three four"), (2, "three four"), (3, "ONE, two - three")]
    got = {r.doc_id: (r.n_items, r.items_sha256) for r in decontam.contamination(docs(spark, rows), bench).collect()}
    assert got == {1: (3, decontam.sha256_of_items(["a", "null", "null"])), 2: (1, decontam.sha256_of_items(["null"])), 3: (2, decontam.sha256_of_items(["a", "null"]))}


def test_columns_of_the_operators_own_names(spark):
    rows = [(1, "one two three"), (2, "other words"), (3, None)]
    df = docs(spark, rows).selectExpr("*", "1 AS __n_words", "2 AS __items", "3 AS __score", "4 AS ___score", "5 AS __spans", "6 AS __N_HIT")
    bench = spark.createDataFrame([("a", "two three")], "item_id string, text string")
    assert [r.doc_id for r in decontam.without_benchmark(df, bench).orderBy("doc_id").collect()] == [2, 3]
    cut = decontam.without_benchmark(df, bench, remove="spans")
    assert cut.columns == df.columns and cut.count() == 3
    with pytest.raises(ValueError, match="__n_words"):
        decontam.mark_hits(df, bench)
    with pytest.raises(ValueError, match="__score"):
        quality.with_scores(df, quality.AttentionModel())
    with pytest.raises(ValueError, match="__ids"):
        bpe.encode(df.selectExpr("*", "1 AS __ids"), public_tokenizers.path("word_bpe_49k.json"))
    long = [(1, ("one two three " * 200_000)), (2, "x " * 500_000)]
    got = decontam.contamination(docs(spark, long), bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit) for r in got] == [(600_000, 400_000), (500_000, 0)]


def test_common_shingles_by_marks_and_by_search():
    rng = np.random.default_rng(9)
    flat = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 5, 80, 200, 200, 300)]
    want = [[len(np.intersect1d(a, b)) for b in flat] for a in flat]
    every = list(range(len(flat)))
    for of in (neardup._marked(flat), neardup._searched(flat)):
        assert [of(h, every).tolist() for h in every] == want
    col = pa.chunked_array([pa.array([s.tobytes() for s in flat[:2]], pa.binary()), pa.array([b"", *[s.tobytes() for s in flat[2:]]], pa.binary()).slice(1)])
    assert all(np.array_equal(a, b) for a, b in zip(neardup._views(col), flat, strict=True))


def test_large_blocks_are_compared_as_small_ones(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{rng.randrange(9999)}" for _ in range(300)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice((2, 5, 9, 14))):
            w[rng.randrange(300)] = f"n{rng.randrange(99999)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(neardup, "CODED", 0)
    assert sorted(tuple(r) for r in near_duplicates(docs(spark, rows)).collect()) == _components(rows)
