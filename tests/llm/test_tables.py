"""Operators on vectors, pages, conversations and shards."""

import base64
import hashlib
import math
import random
import struct

import numpy as np
import pytest
import xxhash

from skumill.llm import chat, html_text, sharding, warc
from skumill.llm.common import components
from skumill.llm.kdsearch import KDTree, top_k


def test_top_k_against_every_pair(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(400)]
    rows += [(i, rows[50][1]) for i in range(400, 520)]  # one very common vector
    rows += [(600, None), (601, [0.1, None, *[0.0] * 6]), (650, [float("nan")] * 8), (651, [float("inf"), *[0.0] * 7]), (700, [1.0, 2.0]), (701, [0.5, 0.5]), (702, []), (None, [0.1] * 8), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "0 AS score", "'x' AS label", "1 AS rank")
    fine = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, a in sorted(fine):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(b) == len(a))
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    for shard_rows in (60, 100_000):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, shard_rows=shard_rows).collect())
        assert got == want
    assert top_k(df.limit(0)).count() == 0


def test_tree_prunes_and_breaks_ties_by_id():
    rng = np.random.default_rng(1)
    points = rng.integers(-5, 5, (2000, 2))
    ids = rng.permutation(2000)
    tree = KDTree(ids, points, leaf=16)
    for q in points[:20]:
        scores = sorted(((int(p @ q), -int(i)) for p, i in zip(points, ids)), reverse=True)[:5]
        assert tree.search(q, -1, 5) == [(s, -i) for s, i in scores]
        assert tree.search(q, -1, 5, kth=(scores[2][0], -scores[2][1])) == [(s, -i) for s, i in scores[:2]]


def _place(key, tree):
    def draw(level, child):
        h = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        for part in (level, child[0]):
            h = xxhash.xxh64(struct.pack("<i", part), seed=h).intdigest()
        return -math.log(((h >> 11) + 0.5) / (1 << 53)) / child[1], child[0]

    for level, at in ((1, 0), (2, 1), (3, 2)):
        weights = {}
        for node in tree:
            weights[node[at]] = weights.get(node[at], 0) + node[3]
        best = min((draw(level, c) for c in weights.items() if c[1] > 0))[1]
        tree = [n for n in tree if n[at] == best]
    return tree[0][2]


def test_shards(spark):
    rows = [(i, "é" * (i % 7)) for i in range(3000)] + [(5, None), (5, None), (5, None), (None, "x"), (None, "x"), (-7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS size", "'z' AS shard", "0 AS slot")
    got = sharding.shard_table(df).collect()
    assert len(got) == len(rows)
    tree = sharding.tree_of(40)
    assert all(r.shard == _place(r.doc_id, tree) for r in got if r.doc_id is not None)
    assert all(r.grown_shard in (r.shard, 40) for r in got) and any(r.grown_shard == 40 for r in got)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert set(by_shard) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert {r["size"] for r in got if r.doc_id == 5} == {16, 16 + 10} and {r.text_crc32 for r in got if r.doc_id == -7} == {0}
    assert sharding.shard_table(df.limit(0)).count() == 0


def test_growth_and_weights_move_only_what_they_must(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    at = lambda tree: {r[0]: r[1] for r in sharding.with_shards(df, tree).collect()}
    for n in (40, 41, 45):
        a, b = at(sharding.tree_of(n)), at(sharding.tree_of(n + 1))
        assert all(b[k] in (a[k], n) for k in a)
    tree = sharding.tree_of(40)
    heavier = [(r, k, s, 3.0 if s == 13 else w) for r, k, s, w in tree]
    a, b = at(tree), at(heavier)
    region = {s: r for r, _, s, _ in tree}
    assert all(region[b[k]] == region[13] for k in a if a[k] != b[k])  # movement ends in the changed subtree
    gone = [(r, k, s, 0.0 if s == 13 else w) for r, k, s, w in tree]
    assert 13 not in at(gone).values()
    with pytest.raises(ValueError):
        sharding.place(sharding.F.col("doc_id"), [(0, 0, 0, 0.0)])


def test_warc_round_trip(spark, tmp_path):
    same = "<p>é" + "x" * 5000
    rows = [(1, "http://www.B.example:8080/a?q=1#f", same), (9, "https://a.example/", same), (4, "https://a.example/", same), (2, None, None), (3, "bad url\r\nX: y", ""), (5, "http://[::1", "WARC/1.1\r\n\r\nx"), (None, "https://a.example/", same), (7, "https://a.example/7", "\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS file", "2 AS payload")
    got = {r.page_id: r for r in warc.archive_and_read(spark, df, str(tmp_path / "archive")).collect()}
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        r = got[page_id]
        assert r.payload_bytes == len(raw) and r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {1: ("revisit", 9), 9: ("response", None), 4: ("revisit", 9), 2: ("revisit", 3), 3: ("response", None), 5: ("response", None), None: ("response", None), 7: ("response", None)}
    assert warc.archive_and_read(spark, df.limit(0)).count() == 0
    small = warc.archive_and_read(spark, df, least_bytes=10).collect()
    assert {r.page_id: r.record_type for r in small}[2] == "response"


def test_index_finds_only_what_it_holds(spark, tmp_path):
    pages = spark.range(300).selectExpr("id AS page_id", "concat('http://h', id % 7, '.example/', if(id < 120, 'same', cast(id AS string))) AS url", "cast(id AS string) AS html")
    folder = f"file://{tmp_path}/archive"
    files = warc.write_archive(warc.with_revisits(pages), folder, file_bytes=2000)
    assert files.count() > 4
    index = warc.build_index(warc.captures(files, folder), lines=10)
    wanted = ["http://h3.example/same", "http://h5.example/201", "http://h1.example/none", "ftp://zzz/"]
    keys = spark.createDataFrame([(warc.surt(u),) for u in wanted], "key string")
    for part_bytes in (1 << 20, 100):
        found = warc.read_captures(warc.find_captures(keys, index, part_bytes), folder).collect()
        assert sorted(r.page_id for r in found) == sorted([*(i for i in range(120) if i % 7 == 3), *([201] if 201 % 7 == 5 else [])])
    assert warc.surt("https://user@WWW.a.b.example/x?y") == "example,b,a)/x?y"


PAGE = """<html><head><title> A &amp; B </title><style>p{}</style></head><body hidden-not><h1>Hi &amp; you</h1><p>One<p>Two <b>bold</b> text<br>next
<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul><table><tr><th>Name<th>Price<tr><td>Long name<td>1<tr><td colspan=2>spans<tr><td>x<td>22</table>
<p hidden>no<p style="color:red; display : none">no</p><div>d1<div>d2</div></div><pre> k
   l</pre><blockquote>q<p>r</blockquote>end<script>var a="</p>";</script><!-- c --> tail < 5</body></html>"""
TEXT = """Hi & you

One

Two bold text
next

- a
- b
  3. x
  4. y
- c

Name       Price
Long name  1
spans
x          22

d1
d2

 k
   l

> q

> r

end tail < 5"""


def test_page_text(spark):
    assert html_text.page_text(PAGE) == TEXT
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<" * 9), (5, "u", "plain"), (5, "u", "plain"), (6, "u", "<div>" * 40_000 + "deep"), (7, "u", "<a b='" * 20_000), (8, "u", "<table><tr><td>a<table><tr><td>in</table>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS title", "1 AS text", "2 AS n_lines")
    got = html_text.extracted(df).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by_id[1].text == TEXT and by_id[1].title == "A & B" and by_id[1].n_lines == TEXT.count("\n") + 1
    assert (by_id[2].text, by_id[2].n_lines, by_id[2].title) == ("", 0, None) and by_id[6].text == "deep" and by_id[4].text == "<" * 9
    assert "in" in by_id[8].text
    assert html_text.extracted(df.limit(0)).count() == 0


def test_end_tags_close_what_they_imply():
    text = html_text.page_text
    assert text("<p>a<div>b</div>c") == "a\n\nb\nc" and text("<b>x</p>y</b>") == "xy"
    assert text("<select><option>a</select>b<textarea><p>k</textarea>") == "b<p>k"
    assert text("<ul><li>a</ul></li>b") == "- a\n\nb" and text("a<br><br>b") == "a\n\nb"
    assert text("<td>x<td>y") == "xy" or text("<td>x<td>y")


def test_pages_without_head_or_body_tags_keep_their_text():
    text = html_text.page_text
    assert text("<html><head><title>t</title><body><p>text</p>") == "text"
    assert text("<html><head><title>t</title><meta charset=x><style>p{}</style>\n<p>one<p>two</html>") == "one\n\ntwo"
    assert text("<head><title>t</title><script>var a</script>words <b>bold</b>") == "words bold"
    assert text("<title>t</title><h1>a</h1>b") == "a\n\nb" and text("<head><base href=x>&amp;<body>b") == "&\nb"
    assert text("<head><noscript><p>no</p></noscript><template><p>no</p></template><title>t</title></head><body>yes") == "yes"
    assert text("<head><noscript><link rel=x></noscript><body>yes") == "yes"


def test_formulas_are_visible():
    assert html_text.page_text("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math> holds") == "so x=2 holds"


def _brute(model, turns):
    import itertools

    best = None
    for roles in itertools.product(range(3), repeat=len(turns)):
        score = model.start[roles[0]] + sum(model.turn[a][b] for a, b in zip(roles, roles[1:])) + sum(t[r] for t, r in zip(turns, roles))
        if best is None or score > best[0] + 1e-9:
            best = (score, list(roles))
    return best[1]


def _conversations(n=120, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(1, 3)
        for t, role in enumerate(roles):
            words = {"system": 8, "user": 12, "assistant": 80}[role]
            rows.append((c, t, role, " ".join("w" * rng.randint(2, 7) for _ in range(words)) + ("?" if role == "user" else ".")))
    return rows


def test_viterbi_is_the_best_path_and_recovers_hidden_roles(spark):
    rows = _conversations()
    kind = "conv_id long, turn long, role string, text string"
    rng = random.Random(9)
    masked = [(c, t, None if rng.random() < 0.3 else r, x) for c, t, r, x in rows]
    got = {(r.conv_id, r.turn): r.role for r in chat.canonical_turns(spark.createDataFrame(masked, kind)).collect()}
    assert sum(got[c, t] == r for c, t, r, _ in rows) / len(rows) > 0.97
    model = chat.Model({("turn", 1, 2): 9, ("turn", 2, 1): 9, ("start", 0, 1): 5, ("first", 2, 33): 7})
    for k in range(20):
        scores = [np.array([rng.uniform(-4, 0) for _ in range(3)]) for _ in range(5)]
        assert chat._viterbi(model, scores, None, None) == _brute(model, scores)
        cut = [[0, 1], [2, 3, 4]]
        pieces = []
        for part, own in enumerate(cut):
            rest = None
            for i in own[1:]:
                rest = chat._product(rest, model.turn + scores[i][None, :])
            pieces.append((part, 1, scores[own[0]].tobytes(), b"" if rest is None else rest.tobytes()))
        fixed = chat._chain(model, pieces)
        assert [r for part, own in enumerate(cut) for r in chat._viterbi(model, [scores[i] for i in own], *fixed[part, 1])] == _brute(model, scores)


def test_a_conversation_over_many_partitions(spark):
    rows = [(1, c * 10 + t, None if (c + t) % 4 == 0 else r, x) for c, t, r, x in _conversations(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    a = sorted(map(tuple, chat.canonical_turns(df, part_bytes=3000).collect()))
    b = sorted(map(tuple, chat.canonical_turns(df.coalesce(1), part_bytes=1 << 40).collect()))
    assert a == b and len(a) == len(rows)


def test_transcript_markers_and_odd_rows(spark):
    text = "User: hello\nmore?\n### Assistant\nhi there\n<|system|>be kind<|im_end|>"
    rows = [(1, 0, None, text), (2, None, "gpt", None), (2, 1, "HUMAN", ""), (2, 1, "HUMAN", ""), (None, 0, "user", "q"), (3, 0, "narrator", "Bot: x\r\nUser: y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'z' AS rendered")
    got = {(r.conv_id, r.turn, r.part): r for r in chat.canonical_turns(df).collect()}
    assert [(got[1, 0, k].role, got[1, 0, k].text) for k in range(3)] == [("user", "hello\nmore?"), ("assistant", "hi there"), ("system", "be kind")]
    assert got[1, 0, 0].rendered == "<|im_start|>user\nhello\nmore?<|im_end|>\n"
    assert got[2, None, 0].role == "assistant" and got[2, 1, 0].n_copies == 2 and got[None, 0, 0].text == "q"
    assert [got[3, 0, k].role for k in range(2)] == ["assistant", "user"]
    assert chat.canonical_turns(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)] + [(200, k) for k in range(201, 260)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and all(got[k] == 200 for k in range(200, 260)) and len(got) == 41 + 2 + 60


def _best(rows, k=5, every=50):
    """All results by brute force in integers without a bound; rows are (vec_id, list of doubles)."""
    from fractions import Fraction

    whole = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows]
    out = []
    for q, a in whole:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(b) == len(a))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e5, 4e6, 2.0**27, 1e11])
def test_components_of_any_size_are_searched(spark, scale):
    rng = np.random.default_rng(12)
    big = 1 if scale < 1e9 else 1e-13  # the largest meet only small ones, so that every score fits a long
    rows = [(i, [float(x) for x in rng.normal(0, scale if i % 7 == 1 and (scale < 1e9 or i % 50) else big, 8)]) for i in range(260)]
    if scale < 1e9:
        rows[0] = (0, [scale / 4] * 8)
        rows[50] = (50, [-scale / 4, *[0.0] * 7])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if scale == 2.0**27:  # two of them have a score of over 2**63
        with pytest.raises(Exception, match="does not fit a long"):
            top_k(df, shard_rows=80).collect()
        return
    assert sorted(map(tuple, top_k(df, shard_rows=80).collect())) == _best(rows)


def test_many_dimensions_and_a_tree_of_unbounded_integers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-(2**19), 2**19, 1024)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, shard_rows=25).collect())) == _best(rows)
    points = np.array([[int(x) * 2**70 for x in row] for row in rng.integers(-9, 9, (300, 3))], dtype=object)
    tree = KDTree(np.arange(300), points, leaf=16)
    for q in ([1, -2, 3], [2**65, 5, -(2**66)]):
        want = sorted(((sum(a * b for a, b in zip(p, q)), -i) for i, p in enumerate(points.tolist())), reverse=True)[:5]
        assert tree.search(np.array(q, dtype=object), -1, 5) == [(s, -i) for s, i in want]


def _grid(rows):
    """Cells (text, columns, rows) on squared paper: {(row, column): text} of the cells' first squares."""
    paper, out = {}, {}
    for r, row in enumerate(rows):
        for text, wide, tall in row:
            c = next(c for c in range(10_000) if (r, c) not in paper)
            out[r, c] = text
            for i in range(r, r + tall if tall else len(rows)):
                for j in range(c, c + wide):
                    paper[i, j] = True
    return out


def test_cells_stand_in_a_grid(spark):
    text = html_text.page_text
    assert text("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>") == "A  b\n   c"
    assert text("<table><tr><td>日本<td>x<tr><td>abc<td>y</table>") == "日本  x\nabc   y"
    assert text("<table><tr><td colspan=2>wide heading<td>z<tr><td>a<td>b<td>c</table>") == "wide heading  z\na  b          c"
    rng = random.Random(17)
    for _ in range(200):
        names = iter(range(1000))
        rows = [[(f"c{next(names)}", rng.choice((1, 1, 1, 2, 3)), rng.choice((1, 1, 2, 3, 0))) for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(1, 6))]
        want = _grid(rows)
        got = {(r, c): lines[0] for r, row in enumerate(html_text.placed([[([t], w, h) for t, w, h in row] for row in rows])) for c, _, lines in row}
        assert got == want
        page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={w} rowspan={h}>{t}</td>" for t, w, h in row) + "</tr>" for row in rows) + "</table>"
        at = {}
        for line in text(page).split("\n"):
            for word in line.split():
                at[word] = line.index(word)
        columns = {}
        for (_, c), t in want.items():
            columns.setdefault(c, set()).add(at[t])
        assert all(len(v) == 1 for v in columns.values())  # a column's cells start at one offset


def test_visibility_follows_the_cascade():
    text = html_text.page_text
    assert text("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>") == "yes"
    assert text("<div style='display:none'>no<b style='display:block'>no</b></div>yes") == "yes"
    assert text("<style>.gone, p#x{display:none} .out{visibility:hidden} @media print{.kept{display:none}} .back{display:none}.back{display:block}</style><p class='a gone'>no<p id=x>no<p class=out>no<p class=kept>one<p class=back>two") == "one\n\ntwo"
    assert text("<style>b{display:none} b.on{display:inline}</style><b>no</b><b class=on>yes</b> <i style='display:inline' hidden>no</i>") == "yes"
    assert text("<details><summary>more</summary><p>inside</details><details open><summary>less</summary><p>shown</details>") == "more\nless\n\nshown"
    assert text("<form><input type=submit value=' Go '><input type=text value=typed><input type=hidden value=no></form>") == "Go"
    assert text("<table><tr><td style='visibility:hidden'>secret<td>b<tr><td>x<td>y</table>") == "   b\nx  y"
    long = "<p style='visibility:hidden'>" + "no <i>no</i> " * 100_000 + "</p>" + "<div>" * 5000 + "yes"
    assert text(long) == "yes"


def test_a_bitmap_says_true_for_every_member(spark):
    from skumill.llm.common import with_maybe_in

    rows = [(k, None if k % 10 == 9 else f"t{k}") for k in range(3000)] + [(None, "t1")]
    df = spark.createDataFrame(rows, "id long, _bits string").selectExpr("*", "1 AS _at", "_bits AS t")
    members = df.where("id % 7 = 0 and t is not null").select("id", "t")
    got = with_maybe_in(df, members, ["id", "t"], "maybe")
    assert got.columns == [*df.columns, "maybe"] and got.count() == len(rows)
    inside = {(r.id, r.t) for r in members.collect()}
    said = [((r.id, r.t) in inside, r.maybe) for r in got.collect()]
    assert all(maybe for own, maybe in said if own)
    assert sum(maybe for own, maybe in said if not own) < 0.15 * len(said)
    assert with_maybe_in(df, members.limit(0), ["id", "t"], "maybe").where("maybe").count() == 0
