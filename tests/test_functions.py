"""Golden values of the column functions."""

import pytest
from pyspark.sql import functions as F

from skumill.functions import html as H
from skumill.functions import price as M
from skumill.functions import sizes as Z
from skumill.functions import spec as P
from skumill.functions import text as X
from skumill.functions import urls as U


def values(spark, make, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("r")).collect()]


CASES = [
    (X.one_space, [" a　 b\n", None], ["a b", None]),
    (X.trimmed, ["　x  ", ""], ["x", ""]),
    (X.clean_text, ["<b>a &amp; b</b>&nbsp;<i>c</i>", "x &lt;y&gt;"], ["a & b c", "x <y>"]),
    (lambda c: X.clean_text(c, True), ["&eacute;&#x41;", None], ["éA", None]),
    (X.metric_weight, ["142 g (5 oz)", "約 1,2 kg", "none", None], ["142 g", "1,2 kg", "none", ""]),
    (X.gender_words, ["Men's Jacket", "WOMENS x", "kid's", "クール メンズ", "レディース"], ["男款 Jacket", "女款 x", "儿童款", "クール 男款", "女款"]),
    (X.before_translation, ["Montbell  Superior Down women's", "WIC. socks"], ["Montbell __SUPERIOR_DOWN__ 女款", "__WIC__ socks"]),
    (X.after_translation, ["__WIC__ 袜子 男款", "Montbell 外套 / 女款", "a , b"], ["男款 WIC. 袜子", "女款 Montbell 外套", "a, b"]),
    (X.range_dashes, ["<td a='1 — 2'>91 — 96</td>", "W 8 – 10.5"], ["<td a='1 — 2'><span class=\"range\">91-96</span></td>", '<span class="range">W 8-10.5</span>']),
    (X.code_prefix, ["A-1-2", " B ", None], ["A", "B", None]),
    (lambda c: X.code_prefix(c, True), [" A-1 "], ["A-1"]),
    (X.stock_word, ["https://schema.org/InStock", "OutOfStock", "soon"], ["in-stock", "out-of-stock", "soon"]),
    (X.dot_word, ["in", "low", "out", "new"], ["あり", "わずか", "なし", "new"]),
    (X.gender_of_name, ["男女同款鞋", "女鞋", "鞋"], ["男款", "女款", "男款"]),
    (X.chart_mode, ["asics", "Lacoste", "montbell", "x"], ["list", "raw", "styled", "table"]),
    (X.chart_title, ["on", "x"], ["推荐尺码表(cm)", None]),
    (X.has_kana, ["カナ", "漢字", "abc"], [True, False, False]),
    (X.has_han, ["カナ", "汉字", "abc"], [False, True, False]),
    (X.plain_table, ["<table border=1><tbody><tr bgcolor='#eee'><td>　</td><td> M </td></tr><tr><th>x</th></tr></tbody></table>", "none"], ['<table><tr bgcolor="#eee"><td>　</td><td>M</td></tr></table>', ""]),
    (lambda c: X.material_text(F.split(c, "\\|")), ["綿| 100% |お手入れ方法|洗濯", "綿|糸"], ["綿100%", "綿糸"]),
    (M.price_text, ["¥ 12,320 税込", "￥980", "free", None], ["12320", "980", "", ""]),
    (M.price_of_json, ['{"displayPrice":"¥1,000","price":5}', '{"price":12.7}', "7", "{}"], ["1000", "12", "7", ""]),
    (M.yen, ["12320.9", "-3.5", "x", "", None], ["¥ 12,320", "¥ -3", "x", "", ""]),
    (M.with_tax, ["100", "7150", "5", "¥ 1", None], ["110", "7865", "6", "¥ 1", None]),
    (M.usable, ["12", "-", "", "nan", None, "24D"], [12.0, None, None, None, None, None]),
    (M.is_number, ["1.5", "1e3", "nan", "24D", "", None], [True, True, True, False, False, False]),
    (M.stock_quantity, ["In-Stock", "low-stock", "out-of-stock", "x", None], ["6", "3", "0", "", ""]),
    (M.size_text, ["24.0", "24.50", "024", "XL ", "24.5", "2D", None], ["24", "24.5", "24", "XL", "24.5", "2D", None]),
    (M.cost_number, ["12,300", "12 300", "-", "2.5", "3.5"], [12300.0, 12300.0, None, 2.0, 4.0]),
    (lambda c: M.differing(c, F.lit("5")), ["5", "4", ""], ["", "4", ""]),
    (M.page_price, ['<i itemprop="price" x content="1,200">', '<b class="value" content="9">', "x"], ["1200", "9", ""]),
    (M.first_yen, ["合計 ￥ 1,200.5 と", "x"], ["¥ 1,200.5", None]),
    (lambda c: M.displayed_price(c, "sales"), ['<div class="buy-config-price"><div class="price"><span class="sales"><span class="value" content="7150.00">', "x"], [7150, None]),
    (U.plain_url, [" /a?x=1&amp;y=2 "], ["/a?x=1&y=2"]),
    (lambda c: U.canonical_product(c, "https://s.example"), ["/product/a/12345.html?dwvar_12345_color=BLK&x=1#t", "https://o.example/p?q"], ["https://s.example/product/a/12345.html?dwvar_12345_color=BLK", "https://o.example/p"]),
    (U.model_of, ["/p/12345.html", "/p/12345.html?x", "/p/a.html"], ["12345", "12345", ""]),
    (U.color_of, ["/prodA1.html?dwvar_x_color=1&dwvar_prodA1_color=2", "/p?dwvar_9_color=R%20D", "/p?selectedColor=Q&dwvar_1_color=Z", "/p"], ["2", "R D", "Q", ""]),
    (U.category_of, ["https://s/ja-jp/c/Women/Tops", "/x"], ["women", ""]),
    (lambda c: U.clean_image(c, H.IMAGE_HOST), [f"https://a.{H.IMAGE_HOST}/i/x.jpg?sw=1&amp;sfrm=jpg", f"https://{H.IMAGE_HOST}/x.jpg", " https://o/x.jpg?sw=1 ", None], [f"https://a.{H.IMAGE_HOST}/i/x.jpg?sfrm=jpg", f"https://{H.IMAGE_HOST}/x.jpg?sfrm=png", "https://o/x.jpg?sw=1", ""]),
    (U.file_name, ["https://s/a/b.jpg?x/y"], ["b.jpg"]),
    (U.safe_name, [' a<b>c:d"e/f\\g|h?i*j '], ["a_b_c_d_e_f_g_h_i_j"]),
    (U.decoded, ["a%20b+c", "100%"], ["a b+c", "100%"]),
    (lambda c: U.versioned("https://c", F.lit("k/x.jpg"), c), ["0123456789abcdef", ""], ["https://c/k/x.jpg?v=0123456789ab", "https://c/k/x.jpg"]),
    (U.unversioned, ["https://c/x.jpg?v=1"], ["https://c/x.jpg"]),
    (lambda c: U.object_key(F.lit("A:b"), F.lit("m/1"), c, F.lit(2)), ["https://s/p.PNG?x=1", "https://s/p"], ["A_b/m_1/p.PNG", "A_b/m_1/image_2.jpg"]),
    (lambda c: U.variant_url(c, F.lit("123"), F.lit("RD"), F.lit("4512345678901"), "https://s"), ["https://s/p/123.html?q=1"], ["https://s/p/4512345678901.html"]),
    (lambda c: U.variant_url(c, F.lit("123"), F.lit("R D"), F.lit(""), "https://s"), ["https://s/p/123.html?q=1&dwvar_9_color=x"], ["https://s/p/123.html?q=1&dwvar_123_color=R+D"]),
    (lambda c: U.variation_url(F.lit("https://s/V"), F.lit("1"), F.lit("C"), c), ["M", ""], ["https://s/V?pid=1&dwvar_1_color=C&dwvar_1_size=M&quantity=1", "https://s/V?pid=1&dwvar_1_color=C&quantity=1"]),
    (P.split_brackets, ["M", "S/M", "L(10/12)", "（22)/24（26/28)", "a(b(c)d)"], ["M", "S,M", "L,10,12", "24,22,26,28", "a,b(c)d,c"]),
    (P.split_deep_brackets, ["M", "S/M", "L(10/12)", "（22)/24（26/28)", "a(b(c)d)", "(a(b(c)))"], ["M", "S,M", "L,10,12", "24,22,26,28", "a,b(c)d,c", "a(b(c)),b(c),c"]),
    (P.han_run, ["LBL浅蓝色 XL 深x灰"], ["浅蓝色深x灰"]),
    (P.color_words, ["黑色/ BLK  x", "黑色-Black", "黑色BLK", "Forge  Grey", "深蓝", "", "a/b/c"], ["黑色/BLK x", "黑色/Black", "黑色/BLK", "Forge Grey", "深蓝", "", "a/b/c"]),
    (P.without_size_words, ["黑色 SIZE XL", "Black Age 3"], ["黑色", "Black"]),
    (lambda c: P.cup_size(c)["jp"], ["10.5(29.0cm)", "S(23.0-25.0)", "M"], ["29.0", None, None]),
    (lambda c: P.cup_size(c)["raw"], ["10.5(29.0cm)", "s(23.0-24.0cm)", "M"], [None, "S", "M"]),
    (Z.eu_or_letter, ["23.5", "43.5", "2XL", "99"], ["15", "27.5", "3L", None]),
    (Z.sock_size, ["2XS", "Q"], ["19-21", None]),
    (Z.canvas_size, ["38", "51.5", "1"], ["24.5", "34", None]),
    (Z.two_chart_sizes, ["38.5", "36.5", "36", "1"], ["24.5,25", "23,23.5", "23", None]),
    (lambda c: Z.outdoor_size(c, F.lit("童鞋"), F.lit("UK")), ["3", "6", "13"], ["22.5", "25.5", "20"]),
    (lambda c: Z.outdoor_size(c, F.lit("男女鞋"), F.lit("EU")), ["42.5", "20/21"], ["27.5", None]),
    (lambda c: Z.outdoor_size(c, F.lit("鞋"), F.lit(None).cast("string")), ["27", "M"], ["27", None]),
    (lambda c: Z.gendered_size(c, F.lit("女款")), ["40", "36", "37"], ["25.5", "22.75", "23"]),
    (lambda c: Z.gendered_size(c, F.lit("男款")), ["40", "35.5", "1"], ["25.25", "0", None]),
    (lambda c: F.array_join(Z.color_codes(c), ","), ["深海军蓝", "LBL浅蓝色 XL", "none"], ["NV", "LBL,LBL25,TQ", None]),
    (Z.known_size, ["L-SS", "L-Q"], ["L-SS", None]),
    (H.title, ["<h1 class=x> A &amp;<b>B</b></h1>", "<TITLE>t</TITLE>", ""], ["A & B", "t", ""]),
    (H.next_page, ['<b class="see-more-button" x data-url="/n?a&amp;b">', '<a data-action="next" href="/2">', "x"], ["/n?a&amp;b", "/2", None]),
    (H.is_challenge, ["<title>Just a moment...</title>", "CF-Turnstile", "ok"], [True, True, False]),
    (H.browser_json, ['<html><pre>{"a":1}</pre>', "<body>[1]</body>", ' {"b":2} '], ['{"a":1}', "[1]", '{"b":2}']),
    (lambda c: H.color_name(c, F.lit("ED")), ['<i data-attr-value="ED" q data-caption="Eddy &amp; B">', '<i data-caption="C" data-attr-value="ED">', '"color":"Jay","sku":"1-ED"', "x"], ["Eddy & B", "C", "Jay", ""]),
    (H.valid_text, [bytearray(b"a\xffb"), bytearray("é".encode())], ["ab", "é"]),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_golden(spark, k):
    make, inputs, want = CASES[k]
    kind = "binary" if isinstance(inputs[0], bytearray) else "string"
    assert values(spark, make, inputs, kind) == want


def test_bid_tiers(spark):
    def python(c, m=1.15):
        import math

        add, div = (2600, 0.99) if c < 11500 else (1900, 0.94) if c <= 78500 else (5930, 0.99)
        return math.ceil((m * c + add) / div / 100) * 100

    costs = [0.0, 1.0, 8321.0, 11499.0, 11499.99, 11500.0, 50000.0, 78500.0, 78501.0, 123456.78]
    assert values(spark, M.bid_price, costs, "double") == [python(c) for c in costs]
    assert values(spark, lambda c: M.bid_price(c, 1.2), costs, "double") == [python(c, 1.2) for c in costs]
    assert values(spark, lambda c: M.bid_price(c, mode="round"), [100.0, None], "double") == [round((1.15 * 100 + 2600) / 0.99 / 100) * 100, None]
    with pytest.raises(ValueError):
        M.bid_price(F.lit(1), mode="floor")


def test_sku_parts(spark):
    got = values(spark, X.sku_parts, ["60421-EDBL-18M", "29157-BLK-L-XL", "BAD-SKU", None])
    assert [tuple(r)[:3] for r in got] == [("60421", "EDBL", "18M"), ("29157", "BLK", "L-XL"), (None, None, None), (None, None, None)]
    assert got[0].error is None and "BAD-SKU" in got[2].error and got[3].error is not None
    assert values(spark, X.size_spellings, ["L-XL", "M"]) == [["L-XL", "L/XL"], ["M"]]


def test_links_resolve_as_in_the_standard_library(spark):
    from urllib.parse import urljoin

    links = ["a", "/x/y", "//h/z", "", "?q=1", "#f", "./a", "../a", "../../../../a", "http://k/l", "x/../y", "a/./b", "mailto:x", "?a=../b"]
    bases = ["https://h.example", "https://h.example/", "https://h.example/a/b/c.html?x=1#f", "https://h.example/a/b/", "https://h.example?x"]
    df = spark.createDataFrame([(x, b) for x in links for b in bases], "l string, b string")
    assert all(r.r == urljoin(r.b, r.l) for r in df.select("l", "b", U.absolute(F.col("l"), F.col("b")).alias("r")).collect())


def test_live_quantity(spark):
    df = spark.createDataFrame([(True, None), (True, -2), (True, 3), (True, 9), (False, 9), (None, 9)], "s boolean, a int")
    assert [r[0] for r in df.coalesce(1).select(M.live_quantity(F.col("s"), F.col("a"))).collect()] == [1, 0, 3, 5, 0, 0]


def test_signatures_and_gallery(spark):
    import hashlib

    row = spark.range(1).select(
        U.signature(F.array(F.lit("b"), F.lit("a")), 12).alias("kept"),
        U.signature(F.array(F.lit("b"), F.lit("a")), 8, "|", False).alias("sorted"),
        H.gallery(F.array(*map(F.lit, ["u/1_B_2.jpg", "u/1_000_9.jpg", "u/1_A_1.jpg", "u/1_B_2.jpg"]))).alias("gallery"),
        H.color_images(F.array(*map(F.lit, ["u/1_A.jpg", "u/1_A_2.jpg", "u/1_000_1.jpg", "u/1_B_1.jpg"])), F.lit("1"), F.lit("A"), F.lit("u/1_A.jpg")).alias("own"),
        H.hero_image(F.array(F.lit("u/x.jpg"), F.lit("u/1_a.JPG")), F.lit("1"), F.lit("A")).alias("hero"),
    ).first()
    assert row.kept == hashlib.md5(b"b\na").hexdigest()[:12] and row.sorted == hashlib.md5(b"a|b").hexdigest()[:8]
    assert row.gallery == ["u/1_000_9.jpg", "u/1_A_1.jpg", "u/1_B_2.jpg"] and row.own == ["u/1_000_1.jpg", "u/1_A_2.jpg"] and row.hero == "u/1_a.JPG"
