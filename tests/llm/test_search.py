"""Ranked lexical search against a plain computation, and its walk against sums over all documents."""

import math
import random
import re

import numpy as np
import pytest

from skumill.llm import lexsearch
from skumill.llm.lexsearch import Postings, build_index, ranked_search, search, summed, walk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    held = [(doc_id, terms(t)) for doc_id, t in docs]
    held = [(d, t) for d, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, own in held:
            m = 75 + 25 * len(own) * n // total
            score = sum(math.floor(1000 * math.log((2.0 * n + 2) / (2.0 * df[x] + 1))) * (1_000_000_000 * own.count(x) // (1000 * own.count(x) + 12 * m)) for x in terms(text) if x in df)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Straße", "日本", "x9"]
    pick = lambda n: " ".join(words[min(int(rng.expovariate(0.12)), len(words) - 1)] for _ in range(n))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(700)]
    docs += [(700, None), (701, ""), (702, "-- !"), (5, "w1 w1 w2"), (5, "w1 w1 w2"), (None, "w1 w40 w41"), (None, "w1 w40 w41"), (703, "W0 w0\tw0." * 3000), (704, "w59"), (705, "w59"), (706, "日本STRAßE")]
    items = [(0, "w1 w2 w2 w40"), (1, "W59!"), (2, "none here"), (3, None), (4, ""), (5, "w0 w1 w2 w3 w4 w5 w6 w50 w55"), (6, "日本 Straße x9"), (7, "w30"), (7, "w30"), (7, "w31"), (None, "w0")]
    return docs, items


def test_ranks_equal_a_plain_computation(spark, corpus, monkeypatch):
    docs, items = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS terms", "0 AS shard")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'z' AS doc_id")
    want = brute(docs, items)
    for shard_bytes in (3000, 1 << 20):
        index = build_index(df.repartition(3), shard_bytes=shard_bytes)
        assert index.count() >= (10 if shard_bytes == 3000 else 1)
        assert sorted(map(tuple, search(index, q).collect()), key=repr) == want
    monkeypatch.setattr(lexsearch, "RANGE", 16)  # reaches the executors with the closure only where they are forked later
    assert sorted(map(tuple, search(index, q, part_bytes=200).collect()), key=repr) == want
    assert sorted(map(tuple, search(index, q, k=3).collect()), key=repr) == brute(docs, items, 3)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    df, q = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    assert ranked_search(df.limit(0), q).count() == 0
    got = ranked_search(df, q.limit(0))
    assert got.count() == 0 and got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_walk_skips_and_misses_nothing(monkeypatch):
    monkeypatch.setattr(lexsearch, "RANGE", 64)
    rng = np.random.default_rng(2)
    n, ranges = 4000, 63
    for trial in range(20):
        lists = []
        for size, top in ((3800, 9), (2500, 30), (900, 200), (120, 2000), (40, 5000), (7, 9000)):
            docs = np.sort(rng.choice(n, size, replace=False))
            lists.append(Postings(docs, rng.integers(1, top, size), ranges))
        sums = np.zeros(n, np.int64)
        for x in lists:
            sums[x.docs] += x.scores
        short = summed(lists[3:], ranges)
        assert short.bound == max(short.scores) and sorted(short.docs) == sorted(set(np.concatenate([x.docs for x in lists[3:]])))
        kth = np.sort(sums)[-10]
        for least in (1, int(kth)):
            seen = []
            docs, scores = walk([short, *lists[:3]], ranges, 10, least, seen)
            assert (sums[docs] == scores).all() and set(np.flatnonzero(sums >= kth)) == set(docs[scores >= kth])
            assert sum(seen) < 1200  # of 4000 documents
    assert walk([], 3, 10, 1)[0].tolist() == []
