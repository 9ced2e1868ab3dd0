"""Deduplication, lookups, titles, manifests, stores, readers, writers and incremental work."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from skumill.functions import html as H
from skumill.operators import dedupe as W
from skumill.operators import extract as E
from skumill.operators import lookup as N
from skumill.operators import manifest as J
from skumill.operators import metrics as A
from skumill.operators import stores as K
from skumill.operators import titles as T
from skumill.sources import readers as R
from skumill.sources import sinks as O
from skumill.streaming import incremental as I


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_first_rows_and_blank_keys(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, "", "z"), (4, "", "w"), (5, None, "v"), (6, " ", "u")], "pos int, k string, v string")
    assert rows(W.first_rows(df.where("k = 'a'"), ["k"], ["pos"])) == [(1, "a", "y")]
    assert [r[0] for r in rows(W.first_rows_keep_blank(df, "k", ["pos"]), "pos")] == [1, 2, 4, 5, 6]
    assert rows(W.dedupe_report(df, "k")) == [(6, 5, 1)]
    assert rows(W.latest(df.where("k = 'a'"), "k", ["pos"])) == [(3, "a", "x")]


def test_runs_and_streaks(spark):
    df = spark.createDataFrame([(1, "A", "u"), (2, "A", None), (3, "B", None), (4, "B", "x"), (5, "A", "w"), (6, None, "n"), (7, None, "m")], "pos int, code string, v string").withColumn("s", F.lit(1))
    got = W.carry_forward(df, ["s"], ["pos"], F.col("code"), F.col("v"))
    assert [r.carried for r in got.orderBy("pos").collect()] == ["u", "u", None, None, "w", "n", "n"]
    bad = spark.createDataFrame([(i, c == "x") for i, c in enumerate("xx.xxxxxx.x")], "pos int, f boolean").withColumn("h", F.lit("h"))
    s = W.failure_streaks(bad, ["h"], ["pos"], F.col("f"))
    assert [r.streak for r in s.orderBy("pos").collect()] == [1, 2, 0, 1, 2, 3, 4, 5, 6, 0, 1]
    assert [(r.pos, r.alert) for r in W.streak_alerts(s, every=3, abort=6).orderBy("pos").collect()] == [(5, "pause"), (8, "abort")]


def test_large_keys_in_parts_give_the_same(spark):
    import random

    rng = random.Random(3)
    data = [(i, rng.choice("ab"), rng.choice(["x", "x", "y", None]), rng.choice([None, i])) for i in range(400)] + [(i, "c", "x", i) for i in range(400, 700)]
    df = spark.createDataFrame(data, "pos int, k string, code string, v int")
    by, order = ["k"], ["pos"]
    for f in (
        lambda n: W.with_runs(df, by, order, F.col("code"), plain_rows=n),
        lambda n: W.carry_forward(df, by, order, F.col("code"), F.col("v"), plain_rows=n),
        lambda n: W.failure_streaks(df, by, order, F.col("code") == "x", plain_rows=n),
    ):
        assert rows(f(0), "pos") == rows(f(10_000), "pos")
    assert W.with_runs(df.limit(0), by, order, F.col("code"), plain_rows=-1).count() == 0


def test_unions_and_pending(spark):
    a, b = spark.createDataFrame([(1, "k1"), (2, "k2")], "pos int, k string"), spark.createDataFrame([(0, "k2"), (1, "k3")], "pos int, k string")
    assert rows(W.union_first([a, b], ["k"], ["pos"]), "k") == [(1, "k1"), (2, "k2"), (1, "k3")]
    one = spark.range(1).select(W.ordered_union(F.array(F.lit("b"), F.lit("a")), F.lit(None).cast("array<string>"), F.array(F.lit("a"), F.lit("c"))))
    assert one.first()[0] == ["b", "a", "c"]
    assert [r.k for r in W.pending(a, b, None, "k").collect()] == ["k1"]
    failed = spark.createDataFrame([("k1",)], "k string")
    assert W.pending(a, b, failed, "k").count() == 0 and W.pending(a, b, failed, "k", True).count() == 1
    assert rows(W.reuse(a, b.withColumnRenamed("pos", "p"), "k", "pos")) == [("k2", 2, 0)]
    order = spark.createDataFrame([(1, "B"), (2, "A"), (3, "B"), (4, None)], "pos int, k string")
    assert [r.pos for r in W.source_order(order, "k", "pos").collect()] == [1, 3, 2, 4]
    assert [r.batch_id for r in W.batch_ids(spark.range(130), "id").orderBy("id").collect()] == [0] * 60 + [1] * 60 + [2] * 10
    assert W.batch_ids(spark.range(0), "id").count() == 0


def test_groups_and_heads(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "A", "y"), (3, None, "z")], "pos int, k string, v string")
    got = {r.k: [x.v for x in r["rows"]] for r in W.grouped(df, "k", ["pos"]).collect()}
    assert got == {"A": ["y", "x"], "": ["z"]}
    assert [r.pos for r in W.first_n(df, ["pos"], 2).collect()] == [1, 2] and W.first_n(df, ["pos"], None).count() == 3


def test_lookups(spark):
    d = spark.createDataFrame([(1, "深蓝", "DB"), (0, "蓝", "B")], "pos int, word string, value string")
    t = spark.createDataFrame([("深蓝色",), ("红",)], "t string")
    assert rows(N.first_contained(t, "t", "word", d, "c"), "t") == [("深蓝色", "B"), ("红", None)]
    assert N.first_contained(t, "t", "word", d.limit(0), "c").where("c is not null").count() == 0
    assert rows(N.equal_lookup(t, "t", spark.createDataFrame([("红", "R")], "key string, value string"), F.lit("-")), "t") == [("深蓝色", "-"), ("红", "R")]
    m = N.multi_value(spark.createDataFrame([(1, 2.0), (1, 1.0)], "key int, value double"), spark.createDataFrame([(1, 2.0), (2, 9.0)], "key int, value double"))
    assert rows(m, "key") == [(1, [1.0, 2.0]), (2, [9.0])]


def test_titles(spark):
    src = ["クール パーカ メンズ", "夏季外套", "Geoline Shirt Women's", "未知 カナ", "カナ のみ", " ", None, "キャップ"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(src)], "i int, Title string")
    cache = spark.createDataFrame([("キャップ", "帽子 男款")], "source string, target string")
    got = T.translate(df, "Title", T.direct_titles(spark), cache)
    assert [r.title_chn for r in got.orderBy("i").collect()] == ["男款凉感连帽外套", "夏季外套", "女款 Geoline Shirt", "未知 カナ", "カナ のみ", "", None, "男款 帽子"]
    assert rows(T.work_list(got)) == [("カナ のみ",)]
    merged = T.merge_cache(cache, spark.createDataFrame([("カナ のみ", "x"), ("キャップ", "y"), ("カナ のみ", "z")], "source string, target string"))
    assert rows(merged, "source") == [("カナ のみ", "x"), ("キャップ", "帽子 男款")]
    wide = spark.createDataFrame([(1, 2, 3)], "titlechn int, a int, TITLE int")
    assert T.place_after(wide, "TitleChn", "title").columns == ["a", "TITLE", "titlechn"]
    assert T.place_after(wide.drop("titlechn"), "TitleChn", "a").columns == ["a", "TitleChn", "TITLE"]
    with pytest.raises(ValueError):
        T.place_after(wide, "x", "none")


def test_size_charts(spark):
    sheet = spark.createDataFrame([("s", i, c, d) for i, (c, d) in enumerate([("A-1", "<b>1</b>"), ("A-2", None), ("B-1", " "), ("B-2", "late"), ("A-3", "91 — 96"), (None, "x"), ("C", "c"), ("D", "d")])], "sheet string, pos int, Code string, Description string")
    there = spark.createDataFrame([("sizetoimg/x/C.jpg", "0123456789abcdef"), ("sizetoimg/x/D.png", "1")], "key string, hash string")
    out, charts = J.size_charts(sheet, there, F.lit("uniqlo"), "https://c")
    got = out.orderBy("pos").collect()
    assert [r.outcome for r in got] == ["created", "created", "blank", "blank", "created", "no code", "reused", "created"]
    assert got[0].size_image == got[1].size_image != "" and got[2].size_image == got[3].size_image == "" and got[6].size_image.endswith("C.jpg?v=0123456789ab")
    pages = {r.key: r.html for r in charts.collect()}
    assert '<span class="range">91-96</span>' in "".join(pages.values()) and "商品尺寸(cm)" in pages["sizetoimg/uniqlo/D.jpg"]
    again, _ = J.size_charts(sheet, there, F.lit("asics"), "https://c", reuse=False)
    assert again.where("outcome = 'reused'").count() == 0
    one = spark.range(1).select(J.chart_html(F.lit("a<br> b "), F.lit("ASICS")).alias("l"), J.chart_html(F.lit(None).cast("string"), F.lit("LACOSTE")).alias("r")).first()
    assert "<li>a</li><li>b</li>" in one.l and one.r.endswith('<div class="mobile-content"></div></body></html>')
    with pytest.raises(ValueError):
        J.size_charts(sheet.drop("Code"), there, F.lit("x"), "https://c")


def test_image_manifest(spark):
    lines = spark.createDataFrame([(0, "B:r\tm/1\thttps://s/a.jpg?x; ;https://s/b"), (1, "b\tm"), (2, "b\tm\t ;"), (3, "b\tn\thttps://s/c.gif")], "pos int, value string")
    images, rejects = J.image_manifest(lines, "https://c")
    assert [(r.pos, r.image_pos, r.key) for r in images.orderBy("pos", "image_pos").collect()] == [(0, 0, "B_r/m_1/a.jpg"), (0, 1, "B_r/m_1/image_1.jpg"), (3, 0, "b/n/c.gif")]
    assert rows(rejects, "pos") == [(1, "malformed line: b\tm"), (2, "no image URL: b/m")]
    out = {r.pos: r.urls for r in J.manifest_lines(images).collect()}
    assert out == {0: "https://c/B_r/m_1/a.jpg;https://c/B_r/m_1/image_1.jpg", 3: "https://c/b/n/c.gif"}
    some, _ = J.image_manifest(lines, "https://c", spark.createDataFrame([("b/n/c.gif",)], "key string"))
    assert some.where("url is not null").count() == 1
    assert rows(A.counts_by(rejects.withColumn("reason", F.split_part("reason", F.lit(":"), F.lit(1))), "reason"), "reason") == [("malformed line", 1), ("no image URL", 1)]
    assert J.refresh_batches(images).select("batch_id").distinct().count() == 1


def test_stores(spark):
    card = lambda n, rest="": f'<div class="card-body"><div class="col store-name"><a>{n}</a></div>{rest}</div>'
    html = "x" * 31_000 + '<h1 class="product-name">N</h1>' + card("Before") + '<i class="results__stores">' + card("A", '<div class="store-availability-message">あり <div>') + card("B", '<i class="dot out">') + card("A") + card("") + '<i class="results__dealers">' + card("D")
    pages = spark.createDataFrame([("1", "u1", html), ("2", "u2", "short")], "item string, url string, html string")
    skus = spark.createDataFrame([("1-RD-M",), ("2-RD-M",), ("3-RD-M",), ("BAD",)], "sku string")
    got = K.store_rows(skus, pages)
    assert [(r.sku, r.note[:12], [(s.name, s.status) for s in r.stores]) for r in got.orderBy("sku").collect()] == [("1-RD-M", "", [("A", "あり"), ("B", "なし")]), ("2-RD-M", "fail-over pa", []), ("3-RD-M", "product page", []), ("BAD", "not item-col", [])]
    wide = K.wide(got)
    assert wide.columns[-4:] == ["shop1", "stock1", "shop2", "stock2"] and rows(wide.where("sku = 'BAD'").select("shop1", "stock2")) == [("", "")]
    assert K.most_stores(got.limit(0)) == 0


def test_readers(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("﻿https://a\n\n# no\n  https://b \n", encoding="utf-8")
    assert [r.seed_url for r in R.seed_list(spark, str(tmp_path / "seeds.txt")).orderBy("pos").collect()] == ["https://a", "https://b"]
    (tmp_path / "none.txt").write_text("# x\n")
    with pytest.raises(ValueError):
        R.seed_list(spark, str(tmp_path / "none.txt"))
    assert R.seed_list(spark, str(tmp_path / "none.txt"), ["d"]).count() == 1
    t = spark.createDataFrame([(" a-1-M ", 1), (None, 2), (" ", 3)], ["x SKU".split()[1].lower().title(), "n"])
    assert [r.sku for r in R.sku_table(t).collect()] == ["a-1-M"]
    with pytest.raises(ValueError):
        R.sku_table(t.select("n"))
    (tmp_path / "s.csv").write_text("h,h,h,h,h,h,h\nA1,24.0,1000,,BK,6,\nA2,M,x,900.5,,0,\n")
    got = R.supply_table(spark, str(tmp_path / "s.csv")).orderBy("pos").collect()
    assert [(r.model, r["size"], r.msrp, r.discounted_price, r.quantity) for r in got] == [("A1", "24.0", 1000.0, None, 6), ("A2", "M", None, 900.5, 0)]
    (tmp_path / "l.csv").write_text("\n".join(["t"] * 3 + [",".join(f"c{i}" for i in range(12)) + ",3,99.5," + ",".join(f"c{i}" for i in range(14, 39))]))
    one = R.listing_table(spark, str(tmp_path / "l.csv")).collect()
    assert len(one) == 1 and (one[0].article, one[0].lead_time, one[0].my_bid, one[0].cost) == ("c7", 3, 99.5, "c14")
    sheet = spark.createDataFrame([("x", "https://s/product/a/12345.html?u=1"), ("/product/b/2.html", "https://s/product/a/12345.html")], "a string, b string").coalesce(1)
    assert [r.url for r in R.product_urls(sheet, "https://s").orderBy("pos").collect()] == ["https://s/product/a/12345.html", "https://s/product/b/2.html"]
    for name in ("e1.csv", "e2.csv", "pref.csv"):
        (tmp_path / name).write_text(name + "\n")
    assert rows(R.newest(spark, str(tmp_path / "e*.csv")))[0][0] == "e2.csv" and rows(R.newest(spark, str(tmp_path / "e*.csv"), smallest=True))[0][0] == "e1.csv"
    assert rows(R.newest(spark, str(tmp_path / "*e*.csv"), preferred="pref.csv"))[0][0] == "pref.csv"
    (tmp_path / "m.tsv").write_text("brand\tmodel\turls\nb\tm\tu\n")
    assert [r.value for r in R.headed_lines(spark, str(tmp_path / "m.tsv")).collect()] == ["b\tm\tu"]
    (tmp_path / "log.json").write_text('{"url":"a","rows":["1"]}\n{bad\n{"url":"a","rows":["2"]}\n{"url":"b","rows":[]}\n')
    assert rows(R.work_log(spark, str(tmp_path / "log.json")), "url") == [("a", ["2"]), ("b", [])]
    good, bad = R.pages(spark.createDataFrame([("a", 200, bytearray(b"x\xff")), ("b", 404, bytearray(b"y")), ("c", 200, None)], "url string, status int, body binary"))
    assert rows(good) == [("a", 200, "x")] and rows(bad, "url") == [("b", "HTTP 404"), ("c", "empty body")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "b int, a string")
    assert rows(O.in_order(df, ["a", "b", "c"])) == [("", "1", "")]
    assert not O.write_failures(df.where("false"), str(tmp_path / "f"))
    failed = spark.createDataFrame([("u", "e")], "url string, error string")
    assert O.write_failures(failed, str(tmp_path / "f")) and spark.read.parquet(str(tmp_path / "f")).count() == 1
    for stamp in ("20240101_000000", "20240102_000000"):
        O.write_run(df, str(tmp_path / "runs"), stamp, "x")
    runs = spark.read.option("recursiveFileLookup", False).parquet(str(tmp_path / "runs"))
    assert rows(O.latest_run(runs).select("run_ts")) == [("20240102_000000",)]
    O.write_lines(df, str(tmp_path / "t"), ["b", "a"], header="h")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["1\t", "h"]
    O.append_log(spark.createDataFrame([("u", ["r"])], "url string, rows array<string>"), str(tmp_path / "log"))
    assert R.work_log(spark, str(tmp_path / "log")).count() == 1
    O.append_errors(failed, str(tmp_path / "err"), "t")
    assert spark.read.parquet(str(tmp_path / "err")).columns == ["time", "url", "error", "elapsed"]
    assert not O.drop_finished(spark, str(tmp_path / "err"), False) and (tmp_path / "err").exists()
    assert O.drop_finished(spark, str(tmp_path / "err"), True) and not (tmp_path / "err").exists()
    assert len(O.listing_output(df).columns) == 42 and dict(O.supply_output(df).dtypes)["sku_id"] == "string"
    O.write_rows(df, str(tmp_path / "rows"), ["a"])
    assert spark.read.parquet(str(tmp_path / "rows")).columns == ["a"]


def test_metrics(spark):
    want, done = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string")
    none = want.where("false")
    assert rows(A.completeness(want, done, none, "k")) == [(2, 1, 0, False)] and rows(A.completeness(want, want, none, "k"))[0][3]
    assert not rows(A.completeness(want, want, done, "k"))[0][3] and not rows(A.completeness(none, none, none, "k"))[0][3]
    items = spark.createDataFrame([("a", "x"), ("b", " ")], "k string, sku string")
    s = A.with_timings(A.run_summary(want, done, items, 3, none, "k"), {"list": 1.5, "detail": 2.0}).first()
    assert (s.found, s.done, s["rows"], s.with_sku, s.removed, s.failed_seeds, s.total_s) == (2, 1, 2, 1, 3, 0, 3.5)
    assert A.total_size(spark.createDataFrame([(2,), (3,)], "fsize int")).first()[0] == 5


LAYER = """<nav class="breadcrumb"><a href="https://s/ja-jp/c/Women/x">w</a></nav><h1> Fall &amp; back </h1>https://img/is/A1B_7_x.jpg https://img/is/ZZ_9_y
<script>digitalData.product.push({"productInfo":{"productID":" P1 ","productName":"Pant%20A"},"price":{"displayRegularPrice":"¥ 9,800","displayPrice":"¥ 8,000"},"linkedProduct":[
{"productInfo":{"sku":"k1","color":"Red","size":"S"},"attributes":{"stockStatus":"in-stock"}},{"productInfo":{"sku":"k2","color":"Red","size":"M","productName":"B+"},"attributes":{"stockStatus":"low-stock"}},{"productInfo":{"sku":"k3","color":"Red","size":"S"},"attributes":{"stockStatus":"in-stock"}}]});
var satelliteData = {"linkedProduct":{"x":{"sku":"k2","price":{"displayRegularPrice":"¥7,000"}}}};</script>"""
LD = '<title>T</title><script type="application/ld+json">{"@type":"Product","name":"N","color":"C","size":"L","offers":{"url":"https://s/prodA.html","price":1200.0,"availability":"https://schema.org/InStock"}}</script><script type="application/ld+json">[{"@type":"Product","offers":{"url":"other"}}]</script><script type="application/ld+json">{bad</script>'


def test_variant_rows(spark):
    pages = spark.createDataFrame([("https://s/prodQ.html?dwvar_prodQ_color=7", LAYER), ("https://s/prodA.html", LD), ("https://s/prodB.html", "<h1>only</h1>"), ("https://s/bad.html", "digitalData.product.push({oops});")], "url string, html string")
    got, failed = E.variant_rows(pages, "house", "https://img/is/")
    r = {(x.url[10:15], x["size"]): x for x in got.collect()}
    assert len(r) == 5 - 1 and rows(failed) == [("https://s/bad.html", "malformed data layer")]
    s, m = r["prodQ", "S"], r["prodQ", "M"]
    assert (s.type, s.title, s.model, s.u_model, s.color, s.msrp, s.discounted_price, s.stock_status, s.quantity, s.brand) == ("women", "Pant A", "P1", "A1B", "Red", "9800", "8000", "in-stock", "6", "house")
    assert (m.title, m.msrp, m.discounted_price, m.quantity) == ("B+", "7000", "", "3")
    a = r["prodA", "L"]
    assert (a.title, a.model, a.msrp, a.stock_status, a.quantity) == ("N", "prodA", "1200", "in-stock", "6")
    assert (r["prodB", ""].title, r["prodB", ""].quantity) == ("only", "")
    none, nothing = E.variant_rows(pages.limit(0), "x", "y")
    assert none.count() == nothing.count() == 0


def test_list_pages(spark):
    link = lambda u: f'<a x class="a search-results-product-name b" q href="{u}">'
    pages = spark.createDataFrame([("https://s/l1", link("/p/1") + link("p2") + link("/p/1") + '<b class="see-more-button" z data-url="/l2">'), ("https://s/l2", link("/p/3") + '<b class="see-more-button" z data-url="/l2">'), ("https://s/m", link("/p/1"))], "url string, html string")
    seeds = spark.createDataFrame([("https://s/l1", 0), ("https://s/m", 1), ("https://s/none", 2)], "seed_url string, pos int")
    got = E.seed_links(pages, seeds)
    assert rows(got, "product_url") == [("https://s/l1", "https://s/p/1"), ("https://s/l1", "https://s/p/3"), ("https://s/l1", "https://s/p2")]
    assert [r.seed_url for r in E.failed_seeds(seeds, got).collect()] == ["https://s/m", "https://s/none"] or E.failed_seeds(seeds, got).count() == 2
    cat = spark.createDataFrame([("https://s/c", '<a href="/product/a/123.html?dwvar_123_color=B&x=1"><a href="/product/b/123.html"><a href="/x">')], "url string, html string")
    assert rows(E.one_link_per_model(cat, "https://s")) == [("https://s/c", "123", "https://s/product/a/123.html?dwvar_123_color=B")]
    good, bad = E.split_pages(spark.createDataFrame([("a", 200, "ok"), ("b", 200, "Page Not Found"), ("c", 500, "x")], "url string, status int, html string"))
    assert [r.url for r in good.collect()] == ["a"] and rows(bad, "url") == [("b", "blocked or missing page"), ("c", "HTTP 500")]


def test_grouped_and_generic_pages(spark):
    data = [{"@type": "ProductGroup", "productGroupID": "55", "name": " Big  Coat ", "brand": {"name": "House"}, "color": ["AA", "BB"]}, {"@type": "Product", "mpn": "55-AA", "color": "Alpha", "size": "S", "sku": "55-AA-S", "gtin13": "4500000000001", "image": "https://i/x.jpg", "offers": {"url": "/product/c/55.html?dwvar_55_color=AA", "price": "1000", "priceSpecification": {"price": "1200"}}}]
    img = f"https://{H.IMAGE_HOST}/"
    html = f"""<script type="application/ld+json">{json.dumps(data)}</script><input name="size" value="S"><input name="size" value="ALL">
<button class="product-swatch" data-color="AA" data-caption="Alpha" data-size-stock='["S"]' data-product-oos='{{"M":"4599999999999"}}'></button><button class="product-swatch" data-attr-value="BB" data-size-stock="bad json"></button>
<img src="{img}55_AA.jpg?sw=2"><img data-src="{img}55_AA_1.jpg" srcset="{img}55_000_2.jpg 1x, {img}55_BB_1.jpg 2x"><h3 class="content-feature__heading">重さ</h3><p>142 g (5 oz)</p><div id="collapsible-2"><p>綿 100%</p><h4>お手入れ方法</h4>水</div>"""
    pages = spark.createDataFrame([("https://s/product/c/55.html", html), ("https://s/product/d/66.html", "<h1>x</h1>")], "url string, html string")
    products, failed = E.product_pages(pages, "https://s", "house")
    p = products.first()
    assert rows(failed) == [("https://s/product/d/66.html", "no ProductGroup")]
    assert (p.title, p.model, p.brand, p.weight, p.material) == ("Big Coat", "55", "house", "142 g", "綿 100%")
    live = spark.createDataFrame([("55", "AA", "S", 9, None, 1500.0)], "model string, color string, size string, ats int, list double, sales double")
    got = {(r.color, r["size"]): r for r in E.catalogue_rows(products, live, "https://s").collect()}
    assert set(got) == {("AA", "S"), ("AA", ""), ("AA", "M"), ("BB", "S"), ("BB", "")}
    s, m, b = got["AA", "S"], got["AA", "M"], got["BB", "S"]
    assert (s.sku, s.msrp, s.discounted_price, s.quantity, s.stock_status, s.url) == ("55-AA-S", "¥ 1,500", "", "5", "在庫あり", "https://s/product/c/4500000000001.html")
    assert s.product_main_image.startswith(img + "55_AA.jpg") and [u.split("/")[-1] for u in s.product_other_image.split("\n")] == ["55_000_2.jpg?sfrm=png", "55_AA_1.jpg?sfrm=png"]
    assert (m.sku, m.quantity, m.stock_status, m.url) == ("55-AA-M", "0", "在庫なし", "https://s/product/c/4599999999999.html") and got["AA", ""].sku == "55-AA"
    assert (b.sku, b.quantity, b.msrp) == ("55-BB-S", "0", "")
    blob = {"a": [{"@type": "Product", "aggregateRating": 4}, {"x": {"@type": "Product", "sku": "66-CC-S", "color": "Cee", "offers": [{"price": "10", "highPrice": "12"}]}}, {"@type": "Product", "sku": "66-CC-M", "color": "Cee", "offers": {"price": "9"}}]}
    loose = spark.createDataFrame([("https://s/g/6600.html", f'<script type="application/json">{json.dumps(blob)}</script><script type="application/json">[</script>')], "url string, html string")
    g = E.generic_products(loose, "house").collect()
    assert len(g) == 1 and g[0].model == "6600" and sorted(g[0].sizes) == ["M", "S"] and g[0].skus == {"S": "66-CC-S", "M": "66-CC-M"} and g[0].color == "Cee"


def test_resume_gives_the_same_as_one_run(spark):
    wanted = spark.createDataFrame([(f"u{i}",) for i in range(6)], "url string")
    log = spark.createDataFrame([("u0", 1, "done", None), ("u1", 1, "failed", "e"), ("u2", 1, "failed", "e"), ("u2", 2, "done", None)], "url string, run int, status string, error string")
    state = {r.url: (r.status, r.attempts, r.last_error) for r in I.latest_status(log).collect()}
    assert state == {"u0": ("done", 1, None), "u1": ("failed", 1, "e"), "u2": ("done", 2, None)}
    left = sorted(r.url for r in I.resume(wanted, log).collect())
    assert left == ["u3", "u4", "u5"] and sorted(r.url for r in I.resume(wanted, log, True).collect()) == ["u1", *left]
    now = dt.datetime(2024, 1, 2)
    old = spark.createDataFrame([("a", now - dt.timedelta(hours=23)), ("b", now - dt.timedelta(hours=25))], "url string, ts timestamp")
    assert [r.url for r in I.fresh_state(old, F.lit(now), 24).collect()] == ["a"]
    seeds = spark.createDataFrame([(0, "x"), (1, "y")], "pos int, u string")
    assert I.job_signature(seeds, "u").first() != I.job_signature(seeds.withColumn("pos", -F.col("pos")), "u").first()


def test_streaming_continues_where_it_ended(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    write = lambda name, *urls: (source / name).write_text("".join(json.dumps({"url": u, "status": s}) + "\n" for u, s in urls))
    write("1.json", ("a", "done"), ("b", "failed"))
    run = lambda: I.run_incremental(spark.readStream.schema("url string, status string").json(str(source)), str(tmp_path / "ck"), I.upsert_status(str(out)), str(tmp_path / "snap"))
    run()
    write("2.json", ("b", "done"), ("c", "failed"))
    run()
    run()
    log = spark.read.parquet(str(out)).withColumn("error", F.lit(None).cast("string"))
    assert log.count() == 4 and {r.url: r.status for r in I.latest_status(log).collect()} == {"a": "done", "b": "done", "c": "failed"}
    assert (tmp_path / "snap" / "batch=0").exists()


def test_streak_alerts_in_a_stream(spark, tmp_path):
    source = tmp_path / "log"
    source.mkdir()
    for part, span in enumerate((range(0, 7), range(7, 20))):
        (source / f"{part}.json").write_text("".join(json.dumps({"host": "h", "ts": i, "failed": True}) + "\n" for i in span))
        time.sleep(0.05)
    log = spark.readStream.schema("host string, ts long, failed boolean").option("maxFilesPerTrigger", 1).json(str(source))
    q = I.streak_stream(log).writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).outputMode("append").start()
    q.awaitTermination()
    assert rows(spark.sql("select ts, streak, alert from alerts"), "ts") == [(5, 6, "pause"), (11, 12, "pause"), (17, 18, "abort"), (18, 19, "abort"), (19, 20, "abort")]


def test_page_chains_of_any_length_and_cycles(spark):
    at = "https://shop.example/list/"
    link = lambda k: f'<a class="see-more-button" data-url="/list/{k}">'
    pages = [(f"{at}{k}", link(k + 1) if k < 1300 else "") for k in range(1301)]
    pages += [(at + "a", link("b")), (at + "b", link("c")), (at + "c", link("b")), (at + "self", link("self")), (at + "last", link("gone"))]
    seeds = [(at + k, n) for n, k in enumerate(("0", "1290", "a", "self", "last", "none"))]
    got = rows(E.page_chain(spark.createDataFrame(pages, "url string, html string"), spark.createDataFrame(seeds, "seed_url string, pos int")))
    want = [(at + "0", f"{at}{k}", k) for k in range(1301)] + [(at + "1290", f"{at}{k}", k - 1290) for k in range(1290, 1301)]
    want += [(at + "a", at + k, n) for n, k in enumerate("abc")] + [(at + "self", at + "self", 0), (at + "last", at + "last", 0), (at + "last", at + "gone", 1), (at + "none", at + "none", 0)]
    assert sorted(got) == sorted(want)


def test_products_at_any_level_of_a_script(spark):
    pages = []
    for level in range(5, 13):  # the product is on this level, under objects and arrays by turns
        node = {"@type": "Product", "sku": f"9999{level}-AAA-S"}
        for k in range(level - 1):
            node = {"k": node} if (level - k) % 2 else [node]
        pages.append((f"https://h/{level}.html", f'<script type="application/json">{json.dumps(node)}</script>'))
    pages.append(("https://h/next.html", '<script type="application/json">' + json.dumps({"props": {"pageProps": {"dehydratedState": {"queries": [{"state": {"data": {"product": {"@type": "Product", "sku": "77777-AAA-S"}}}}]}}}}) + "</script>"))
    got = E.nested_objects(spark.createDataFrame(pages, "url string, html string")).select("url", F.try_variant_get("object", "$.sku", "string").alias("sku")).where("sku is not null")
    assert sorted(r.url for r in got.collect()) == sorted(u for u, _ in pages)
    assert E.generic_products(spark.createDataFrame(pages, "url string, html string"), "house").count() == len(pages)


def test_store_pages_are_shuffled_not_broadcast(spark):
    skus = spark.createDataFrame([("1-x-Red-M",), ("2-x-Red-M",)], "sku string")
    pages = spark.range(1, 3).selectExpr("cast(id AS string) AS item", "concat('u', id) AS url", "repeat('<!-- -->', 4000) AS html")
    rows = K.store_rows(skus, pages)
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_hosts_rows_enter_its_state_in_one_call():
    calls = []

    class Handle:
        def getValueState(self, *a):
            return self

        def getListState(self, *a):
            return self

        def appendList(self, rows):
            calls.append(list(rows))

        def registerTimer(self, at):
            calls.append(at)

    state = I._Streaks(2, 3, 1000)
    state.init(Handle())
    assert list(state.handleInputRows(("h",), iter([{"at": 5000 - k, "tie": k, "failed": k % 2} for k in range(3)]), None)) == []
    assert calls == [[(5000, 0, False), (4999, 1, True), (4998, 2, False)], 5]
