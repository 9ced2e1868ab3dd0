"""Roles of transcripts: recovery on the given conversations, and the whole job against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from skumill.llm import chat
from skumill.llm.queries import op1_chat_turns

KIND = "conv_id long, turn long, role string, text string"


def conversations(spark):
    return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")


def test_roles_of_held_out_conversations_are_recovered(spark):
    got = op1_chat_turns(spark, "/root/testdata/sf0.01").withColumn("held", ~F.udf(chat.learns, "boolean")("conv_id"))
    assert got.count() == conversations(spark).count() and got.where("held").count() > 100
    for part in (got, got.where("held")):
        assert part.where("role = given_role").count() / part.count() > 0.95


def test_transcripts_with_markers_are_taken_apart_again(spark):
    rows = sorted(map(tuple, conversations(spark).select("conv_id", "turn", "role", "text").collect()))
    styles = [lambda r, x: f"{r.title()}: {x}", lambda r, x: f"### {r.title()}\n{x}", lambda r, x: f"<|im_start|>{r}\n{x}<|im_end|>", lambda r, x: f"[{r}] {x}", lambda r, x: f"**{'Human' if r == 'user' else r}**: {x}"]
    whole = [(conv, 0, None, "\n".join(styles[conv % 5](r, x) for _, _, r, x in own)) for conv, own in itertools.groupby(rows, lambda r: r[0])]
    # a few rows with roles to learn from
    taught = [r for r in rows if r[0] % 4 == 0]
    df = spark.createDataFrame(whole + [(c + 10_000, t, r, x) for c, t, r, x in taught], KIND)
    got = sorted((r.conv_id, r.part, r.role, r.text) for r in chat.canonical_turns(df).where("conv_id < 10000").collect())
    want = sorted((c, t, r, x.strip()) for c, t, r, x in rows)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert sum(g[2] == w[2] for g, w in zip(got, want)) / len(want) > 0.98


def _by_hand(rows, hidden):
    """The turns of small conversations: counts, model and every path, in plain Python."""
    convs = {}
    for (c, t, r, x), n in Counter(rows).items():
        convs.setdefault(c, []).append((t, r, x, n))
    counts = Counter()
    parsed = {}
    for c, own in convs.items():
        own.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1] is not None, z[1] or ""))
        parsed[c] = [(t, r, n, *chat.turns_of(x, r)) for t, r, x, n in own]
        if hidden and not chat.learns(c):
            continue
        before = "start"
        for _, r, _, bodies, features in parsed[c]:
            label, mark, first, *kinds = features[0]
            if label < 3:
                if before == "start":
                    counts["start", 0, label] += 1
                elif before is not None:
                    counts["turn", before, label] += 1
                counts["mark", label, mark] += 1
                counts["first", label, first] += 1
                for k, m in enumerate(kinds):
                    counts["kind", label, k] += m
            before = label if label < 3 and len(bodies) == 1 else None

    def table(name, row, prior):
        seen = [p + counts[name, row, k] for k, p in enumerate(prior)]
        return [math.log(v / sum(seen)) for v in seen]

    start = table("start", 0, [1] * 3)
    turn = [table("turn", r, [1] * 3) for r in range(3)]
    mark = [table("mark", r, [0.99 if k == r else 0.01 for k in range(3)] + [1]) for r in range(3)]
    first = [table("first", r, [1] * (5 * chat.SIZES)) for r in range(3)]
    kind = [table("kind", r, [1] * 5) for r in range(3)]
    out = []
    for c, own in parsed.items():
        seen = [(t, k, r, n, body, f) for t, r, n, bodies, features in own for k, (body, f) in enumerate(zip(bodies, features))]
        best = None
        for path in itertools.product(range(3), repeat=len(seen)):
            score = start[path[0]] + sum(turn[a][b] for a, b in zip(path, path[1:]))
            for r, (*_, (label, m, f, *kinds)) in zip(path, seen):
                said = 0 if hidden or label == 3 else math.log(0.99 if label == r else 0.005)
                score += said + mark[r][m] + first[r][f] + sum(n * kind[r][k] for k, n in enumerate(kinds))
            if best is None or score > best[0] + 1e-9:
                best = (score, path)
        for r, (t, k, given, n, body, _) in zip(best[1], seen):
            name = chat.ROLES[r]
            out.append((c, t, k, given, name, body, chat.RENDERED.format(name, body), n))
    return sorted(out, key=repr)


def test_the_whole_job_against_every_path(spark):
    rng = random.Random(21)
    rows = []
    for c in [None, *range(1, 31)]:
        roles = (["system"] if rng.random() < 0.3 else []) + ["user", "assistant"] * rng.randint(1, 2)
        for t, r in enumerate(roles):
            words = " ".join("w" * rng.randint(1, 9) for _ in range({"system": 3, "user": 9, "assistant": 60}[r]))
            text = rng.choice([words + "?", "- " + words, words + "\n" + words, f"{r}: {words}", "", "```\n" + words, f"x\n### {rng.choice(('User', 'Bot'))}\n{words}"])
            rows.append((c, t, rng.choice([r, r, r, None, "narrator", r.upper()]), text))
    rows += [rows[3], rows[3], (40, None, None, None), (40, 1, "human", "x" * 3000)]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS part", "'z' AS rendered", "2 AS chunk")
    for labels in ("seen", "hidden"):
        want = _by_hand(rows, labels == "hidden")
        got = chat.canonical_turns(df.coalesce(1).repartition(1), labels=labels)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    # chunks of a few rows, all within partitions whose bounds only lose some counts of pairs
    again = chat.canonical_turns(df, chunk_bytes=200, labels="seen")
    assert again.count() == len(_by_hand(rows, False))


def test_very_long_texts_and_products():
    long = "\n".join(["word " * 20] * 50_000)
    bodies, features = chat.turns_of(long, "user")
    assert len(bodies) == 1 and sum(features[0][3:]) == 49_999 and features[0][2] == 4 * chat.SIZES + chat.SIZES - 1
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 8):
        mats = rng.normal(size=(n, 3, 3))
        want = None
        for m in mats:
            want = chat._product(want, m)
        assert np.allclose(chat._product_of(mats), want)
