"""Sizes in brackets of any depth against a plain stack."""

import random

from pyspark.sql import functions as F

from skumill.functions import spec as P


def _plain(t):
    stack, pairs = [], []
    for i, ch in enumerate(t):
        if ch in "(（":
            stack.append(i)
        elif ch in ")）" and stack:
            pairs.append((stack.pop(), i))
    pieces = lambda s: [p.strip() for p in s.split("/") if p.strip()]
    if not pairs:
        return ",".join(pieces(t)) if "/" in t else t
    outside = "".join(ch for i, ch in enumerate(t) if not any(a <= i <= b for a, b in pairs)).strip()
    out = pieces(outside)
    for a, b in sorted(pairs):
        body = t[a + 1 : b].strip()
        out += pieces(body) if "/" in body else [body]
    return ",".join(out)


def test_brackets_of_any_depth(spark):
    rng = random.Random(1)
    texts = ["", "S", "S/M", "(" * 40 + "x" + ")" * 40] + ["".join(rng.choice("()（）/ SM") for _ in range(rng.randint(1, 14))) for _ in range(800)]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", P.split_brackets(F.col("t")).alias("any"), P.split_deep_brackets(F.col("t")).alias("deep")).collect()
    assert all(r["any"] == r.deep == (None if r.t is None else _plain(r.t)) for r in rows)
