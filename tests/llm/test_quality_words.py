"""The quality classifier's view of words."""

import zlib

import numpy as np

from skumill.llm import quality


def corpus(n=900, seed=5):
    """Labels that depend on words alone: all words are orders of the same eight letters."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.permutation(list("abcdefgh")))
    kinds, common = [[word() for _ in range(200)] for _ in range(2)], [word() for _ in range(400)]
    out = []
    for d in range(n):
        label = int(rng.integers(2))
        pick = lambda: kinds[label][rng.integers(200)] if rng.random() < 0.3 else common[rng.integers(400)]
        out.append((d, " ".join(pick() for _ in range(rng.integers(30, 300))), label))
    return out


def area(scores, labels):
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_words_alone_tell_good_from_bad(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id int, text string")
    labels = spark.createDataFrame([(d, q) for d, _, q in rows], "doc_id int, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    held = [d for d, *_ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out == (d in set(held)) for d, *_ in rows)
    assert area(np.array([got[d].score for d in held]), np.array([rows[d][2] for d in held])) > 0.95


def test_pairs_stay_within_passages_and_rows():
    raw = [b"a b c", b"", b"c", (b"w " * 100)]
    offs = np.cumsum([0, *map(len, raw)])
    got = quality.encode(np.frombuffer(b"".join(raw), np.uint8), offs)
    assert got.bounds.tolist() == [0, 1, 1, 2, 5] and got.first.tolist() == [0, 3, 4, 52, 100]
    ends = [2, 3, 51, 99, 103]
    assert (got.words[ends, 1] == 0).all() and (np.delete(got.words[:, 1], ends) > 0).all() and (got.words[:, 0] > 0).all()
    rows = got.rows()
    back = quality.joined(rows)
    assert [len(r.x) for r in rows] == [1, 0, 1, 3]
    assert all((getattr(got, n) == getattr(back, n)).all() for n in ("x", "words", "first", "bounds"))
    alone = quality.AttentionModel()
    alone.p["E"][1:] = np.random.default_rng(1).standard_normal((quality.BUCKETS - 1, quality.WIDTH))
    each = [alone.score(r)[0] for r in rows]
    assert np.allclose(alone.score(got), each, atol=1e-6)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    raw = [b"one two three four five " * 30, b"three. six, seven", b"one " * 60]
    bags = quality.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    model, labels = quality.AttentionModel(), np.array([1.0, 0.0, 1.0])
    model.p = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in model.p.items()}
    model.p["E"][0] = 0
    keep = np.ones(bags.words.shape)

    def loss():
        s = model.forward(bags, keep)[0]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    s, f = model.forward(bags, keep)
    found = model._gradients((s - labels) / len(labels), f)
    for name, g in found.items():
        used = np.argwhere(np.abs(g) > 1e-6)
        for at in map(tuple, used[rng.choice(len(used), min(5, len(used)), replace=False)]):
            own = model.p[name][at]
            model.p[name][at] = own + 1e-5
            up = loss()
            model.p[name][at] = own - 1e-5
            down = loss()
            model.p[name][at] = own
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5 + 1e-3 * abs(g[at]), name
