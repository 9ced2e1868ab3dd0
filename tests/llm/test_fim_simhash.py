"""Fill-in-the-middle and SimHash against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skumill.llm import simhash
from skumill.llm.fim import fim_digests, restored, with_fim
from skumill.llm.simhash import ball_edges, fingerprints, simhash_duplicates, xxh64_spans


def fim(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


def texts_with_lines():
    rng = random.Random(6)
    fixed = [None, "", "\n", "a", "a\n", "\n\n", "<P>", "a<S>\nb", "é\r\n日本\n", "<\nS>\n<M", "x" * 300_000 + "\n" + "y\n" * 50_000]
    return fixed + ["".join(rng.choice("ab<PSM>\né ") for _ in range(rng.randrange(50))) for _ in range(400)]


def test_fim_against_a_plain_cut(spark):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts_with_lines())] + [(3, "a"), (3, "a"), (-1, "b\nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_chars", "'k' AS `__h0`")
    for rate, spm in ((100, 50), (40, 100), (0, 0)):
        made = with_fim(df, rate=rate, spm=spm).withColumn("back", restored(F.col("form"), F.col("output"))).collect()
        assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in made), key=repr) == sorted(((d, t, *fim(d, t, rate, spm)) for d, t in rows), key=repr)
        assert all(r.back == (r.text or "") for r in made)
    got = fim_digests(df).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(d, *fim(d, t)[:2], *[None if x is None else len(x) for x in fim(d, t)[2:4]], sha(fim(d, t)[5]), sha(t or "")) for d, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert with_fim(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        with_fim(df.withColumn("FORM", F.lit(1)))
    assert with_fim(df.withColumn("form", F.lit(1)), keep=["output"]).columns == [*df.columns, "form", "output"]
    ints = spark.createDataFrame([(1, 7)], "doc_id int, text int")  # not text at all
    assert fim_digests(ints).first().n == 1


def simple(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_hash_and_fingerprints(monkeypatch):
    rng = random.Random(3)
    spans = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(1, 200), 31, 32, 33, 5000]]
    ends = np.cumsum([len(x) for x in spans])
    assert xxh64_spans(np.frombuffer(b"".join(spans), np.uint8), ends - [len(x) for x in spans], ends).tolist() == [xxhash.xxh64_intdigest(x, 42) for x in spans]
    assert xxh64_spans(np.zeros(0, np.uint8), ends[:0], ends[:0]).tolist() == []
    texts = ["", " \t", "A", "a  b", "Über ÄÖ x y\nz Q", "a b c", "A b C d " * 50, None] + [" ".join(rng.choice(["the", "Cat", "x" * 200, "é"]) for _ in range(rng.randrange(30))) for _ in range(100)]
    raw = [(t or "").encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    for size in (7, 1 << 16):
        monkeypatch.setattr(simhash, "PASS", size)
        assert fingerprints(np.frombuffer(b"".join(raw), np.uint8), offs).tolist() == [simple(t) for t in texts]


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("group_rows", [8, 4096])
def test_ball_edges_connect_what_pairs_do(spark, group_rows):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63]
    near = [b ^ sum(1 << p for p in rng.sample(range(64), d)) for b in base for d in (1, 2, 3, 3, 4)]
    chain, at = [], 5
    for _ in range(60):  # one long chain and one dense ball
        at ^= sum(1 << p for p in rng.sample(range(64), 3))
        chain.append(at)
    ball = [77 ^ (1 << p) ^ (1 << q) for p in range(12) for q in range(p)]
    fps = sorted({*base, *near, *chain, *ball})
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    got = [(r.u % 2**64, r.v % 2**64) for r in ball_edges(df, group_rows).collect()]
    assert len(got) < 60 * len(fps)
    assert classes(fps, got) == classes(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3])
    assert ball_edges(df.limit(0), group_rows).count() == 0


def test_simhash_components(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        own = [rng.choice(words) for _ in range(rng.randrange(150, 400))]
        rows.append((1000 - i, " ".join(own)))
        for k in range(rng.randrange(3)):
            own = own[:]
            own[rng.randrange(len(own))] = "changed"
            rows.append((2000 + 10 * i + k, "  ".join(own).upper() if k else " ".join(own)))
    rows += [(3000, None), (2999, ""), (2998, " \n"), (1000, rows[0][1]), (1000, rows[0][1]), (None, rows[0][1]), (None, "quite alone here"), (None, "quite alone here"), (7, "two words"), (6, "TWO  words"), (5, "x " * 100_000)]
    fp = [simple(t) for _, t in rows]
    at = classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[at[i]] = min(d, least.get(at[i], d))
    want = sorted(((d, f"{fp[i]:016x}", least.get(at[i])) for i, (d, _) in enumerate(rows)), key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "'x' AS component_id")
    got = simhash_duplicates(df).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    assert len({c for *_, c in want}) < len({f for _, f, _ in want})
    assert simhash_duplicates(df.limit(0)).count() == 0
