"""Queries over pages that Spark composes from part: fall-backs of the extraction, images, links and page columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import html as H
from .functions import price as M
from .functions import urls as U
from .operators import extract as E
from .operators import stores as K
from .operators.bind import bound
from .queries import _spread_parts
from .registry import query, table
from .sources import sinks as O

SITE = "https://shop.example"
IMAGES = "https://" + H.IMAGE_HOST


def _pages(spark: SparkSession, sf_dir: str, url: str, html: str, *more: str) -> DataFrame:
    """(url, html) of each part, given as SQL over part; the parts are dealt over all tasks first.

    A page is bound, or it would be composed anew wherever it is read.
    """
    parts = _spread_parts(spark, sf_dir, True)
    return bound(parts.selectExpr("p_partkey AS k", f"{url} AS url", f"{html} AS html", *more), url=F.col("url"), html=F.col("html"))


# --- rows of a product page: JSON-LD, a bare page, prices of their own -------------


@query(
    """WITH b AS (SELECT p_partkey AS k, p_name, p_size, floor(p_retailprice) AS price FROM part),
u AS (SELECT *, 'https://shop.example/p/prod' || k || '.html' || CASE WHEN k % 2 = 0 THEN '?dwvar_prod' || k || '_color=C7' ELSE '' END AS url FROM b)
SELECT url, p_name AS title, 'prod' || k AS model, CASE k % 4 WHEN 0 THEN 'STYLE' || k WHEN 1 THEN 'OTHER' || k ELSE '' END AS u_model, CASE WHEN k % 3 = 0 THEN '' ELSE 'Colour ' || c END AS color,
  CASE WHEN k % 3 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS size, CASE WHEN k % 3 = 0 THEN '' ELSE CAST(CAST(price + c AS BIGINT) AS VARCHAR) END AS msrp,
  CASE WHEN k % 3 = 0 THEN '' WHEN c = 0 THEN 'in-stock' ELSE 'out-of-stock' END AS stock_status, CASE WHEN k % 3 = 0 THEN '' WHEN c = 0 THEN '6' ELSE '0' END AS quantity
FROM u, (VALUES (0), (1)) v(c) WHERE c = 0 OR k % 3 <> 0"""
)
def page_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a data layer: two products in JSON-LD beside one of another model, or nothing but a heading."""
    url = "concat('https://shop.example/p/prod', p_partkey, '.html', CASE WHEN p_partkey % 2 = 0 THEN concat('?dwvar_prod', p_partkey, '_color=C7') ELSE '' END)"
    item = lambda c, model: f"""concat('{{"@type":"Product","color":"Colour {c}","size":"', p_size, '","offers":{{"url":"/p/{model}', p_partkey, '.html","price":"', cast(floor(p_retailprice) + {c} AS bigint), '","availability":"https://schema.org/{"InStock" if c == 0 else "OutOfStock"}"}}}}')"""
    data = f"concat('<script type=\"application/ld+json\">[', {item(0, 'prod')}, ',', {item(1, 'prod')}, ',', {item(0, 'prod')}, ',', {item(2, 'else')}, ']</script>')"
    images = "CASE p_partkey % 4 WHEN 0 THEN concat('<img src=\"https://i.example/OTHER', p_partkey, '_C9_1.jpg\"><img src=\"https://i.example/STYLE', p_partkey, '_C7_1.jpg\">') WHEN 1 THEN concat('<img src=\"https://i.example/OTHER', p_partkey, '_C9_1.jpg\">') ELSE '' END"
    pages = _pages(spark, sf_dir, url, f"concat('<html><h1> ', p_name, '</h1>', {images}, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE {data} END, '</html>')")
    rows, _ = E.variant_rows(pages, "house", "https://i.example/")
    return rows.select("url", "title", "model", "u_model", "color", "size", "msrp", "stock_status", "quantity")


@query("SELECT 'https://shop.example/p/prod' || p_partkey || '.html' AS url, CASE WHEN p_partkey % 4 = 0 THEN 'malformed data layer' ELSE 'HTTP 503' END AS error FROM part WHERE p_partkey % 4 IN (0, 1)")
def failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose data is no JSON or that did not load, in a failure table; a table of none is not written."""
    html = "concat('<h1>', p_name, '</h1>', CASE WHEN p_partkey % 4 = 0 THEN '<script>digitalData.product.push({\"a\":});</script>' ELSE '' END)"
    pages = _pages(spark, sf_dir, "concat('https://shop.example/p/prod', p_partkey, '.html')", html, "CASE WHEN p_partkey % 4 = 1 THEN 503 ELSE 200 END AS status")
    loaded, lost = E.split_pages(pages)
    _, malformed = E.variant_rows(loaded, "house", "https://i.example/")
    path = O.fresh_path(spark, "failures")
    O.write_failures(lost.unionByName(malformed), path)
    if O.write_failures(lost.where("false"), path + "-none"):
        raise AssertionError("an empty failure table was written")
    return spark.read.parquet(path)


@query(
    """SELECT 'https://shop.example/p/prod' || p_partkey || '.html' AS url, 'K' || s AS sku, CAST(CAST(CASE WHEN s = 1 THEN floor(p_retailprice) + 9 ELSE floor(p_retailprice) END AS BIGINT) AS VARCHAR) AS msrp,
  CASE WHEN s = 1 THEN '' ELSE CAST(CAST(floor(p_retailprice * 0.5::DOUBLE) AS BIGINT) AS VARCHAR) END AS discounted_price FROM part, (VALUES (1), (2)) v(s)"""
)
def page_own_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that variants have for themselves; the second entry of a SKU counts, a list may be an object."""
    full, half, more = "cast(floor(p_retailprice) AS bigint)", "cast(floor(p_retailprice * 0.5D) AS bigint)", "cast(floor(p_retailprice) + 9 AS bigint)"
    one = lambda sku, a, b: f"""concat('{{"sku":"{sku}","price":{{"displayRegularPrice":"¥ ', {a}, '","displayPrice":"', {b}, '"}}}}')"""
    entries = [one("K1", full, half), one("K2", full, half), one("K1", more, more)]
    listed = f"concat('[', concat_ws(',', {', '.join(entries)}), ']')"
    keyed = "concat('{', concat_ws(',', " + ", ".join(f"""concat('"{n}":', {e})""" for n, e in zip("abc", entries, strict=True)) + "), '}')"
    html = f"concat('<script>var satelliteData = {{\"linkedProduct\":', CASE WHEN p_partkey % 2 = 0 THEN {listed} ELSE {keyed} END, '}};</script>')"
    return E.variant_prices(_pages(spark, sf_dir, "concat('https://shop.example/p/prod', p_partkey, '.html')", html))


# --- grouped pages without swatches, items that name only a rating --------------------


@query(
    """SELECT 'https://shop.example/product/x/' || p_partkey || '.html' AS url, lower(split_part(p_brand, '#', 1)) AS brand, c AS code, CASE c WHEN 'AAA' THEN 'Last' ELSE 'Shade' END AS name, 'M' AS sizes,
  CASE c WHEN 'AAA' THEN '900' ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS offer_price, CASE c WHEN 'AAA' THEN '900' ELSE CAST(CAST(floor(p_retailprice) + 100 AS BIGINT) AS VARCHAR) END AS msrp,
  CASE c WHEN 'BBB' THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS discounted_price FROM part, (VALUES ('AAA'), ('BBB')) v(c)"""
)
def swatchless_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without swatches the schema's own colours count, the last item of each; a list price makes the offer a discount."""
    item = lambda c, name, price, spec="": f"""concat('{{"@type":"Product","mpn":"', p_partkey, '-{c}-M","color":"{name}","offers":{{"price":"', {price}, '"{spec}}}}}')"""
    price = "cast(floor(p_retailprice) AS bigint)"
    extra = ""","priceSpecification":{"price":"', cast(floor(p_retailprice) + 100 AS bigint), '"}"""
    group = """concat('{"@type":"ProductGroup","productGroupID":"', p_partkey, '","name":"', p_name, '","brand":{"name":"', split_part(p_brand, '#', 1), '"}}')"""
    data = f"concat('[', concat_ws(',', {group}, {item('AAA', 'First', price)}, {item('BBB', 'Shade', price, extra)}, {item('AAA', 'Last', chr(39) + '900' + chr(39))}), ']')"
    html = f"concat('<script type=\"application/ld+json\">', {data}, '</script><input type=\"radio\" name=\"size\" value=\"M\">')"
    products, _ = E.product_pages(_pages(spark, sf_dir, "concat('https://shop.example/product/x/', p_partkey, '.html')", html), SITE, "house")
    return products.select("url", "brand", F.explode("colors").alias("c")).selectExpr("url", "brand", "c.code", "c.name", "array_join(c.sizes, ',') AS sizes", "c.offer_price", "c.msrp", "c.discounted_price")


@query("SELECT 'https://shop.example/r/' || p_partkey || '.html' AS url, CASE WHEN p_partkey % 3 = 0 THEN 'default' ELSE 'RED' END AS color, CASE WHEN p_partkey % 3 = 0 THEN '5' ELSE '7' END AS msrp FROM part")
def rating_only_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product object without number and colour is left out, unless a page has no other."""
    rating, real = """'{"@type":"Product","name":"stars","offers":{"price":"5"}}'""", """'{"@type":"Product","color":"RED","offers":{"price":"7"}}'"""
    html = f"concat('<script type=\"application/ld+json\">[', {rating}, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat(',', {real}) END, ']</script>')"
    return E.generic_products(_pages(spark, sf_dir, "concat('https://shop.example/r/', p_partkey, '.html')", html), "house").select("url", "color", "msrp")


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN CAST(floor(p_retailprice) AS BIGINT) END AS sale, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) END AS listed FROM part")
def displayed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = lambda kind, v: f"concat('<span class=\"{kind}\"><span class=\"value\" content=\"', {v}, '\"></span></span>')"
    html = f"concat('<div class=\"buy-config-price x\">', {value('strike-through list', 'CASE WHEN p_partkey % 3 = 0 THEN cast(p_size AS string) ELSE chr(45) END')}, {value('sales', 'CASE WHEN p_partkey % 2 = 0 THEN cast(p_retailprice AS string) ELSE chr(120) END')}, '</div>')"
    pages = _pages(spark, sf_dir, "'u'", html)
    return pages.select("k", M.displayed_price(F.col("html"), "sales").alias("sale"), M.displayed_price(F.col("html"), "strike-through list").alias("listed"))


# --- links, seeds and images ----------------------------------------------------------


@query(
    """SELECT 'https://shop.example/c/' || (p_partkey // 10) AS url, CAST(p_partkey AS VARCHAR) AS model, 'https://shop.example/product/a/' || p_partkey || '.html' || CASE WHEN p_partkey % 2 = 0 THEN '?dwvar_' || p_partkey || '_color=RED' ELSE '' END AS link FROM part"""
)
def category_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One link a model: the first of a category page, with only its colour parameter; other links are none."""
    first = "concat('<a href=\"/product/a/', p_partkey, '.html', CASE WHEN p_partkey % 2 = 0 THEN concat('?dwvar_', p_partkey, '_color=RED&amp;u=1#top') ELSE '?u=2' END, '\">x</a>')"
    link = f"concat({first}, '<a class=c href=\"/product/b/', p_partkey, '.html\"><a href=\"/help/', p_partkey, '.html\">')"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{link} AS l").groupBy(F.expr("concat('https://shop.example/c/', p_partkey div 10)").alias("url"))
    return E.one_link_per_model(rows.agg(F.array_join(F.collect_list("l"), "").alias("html")), SITE)


@query(
    """WITH l AS (SELECT p_partkey // 40 AS seed, p_partkey // 10 % 4 AS step, p_partkey % 10 AS spot, 'https://shop.example/p/' || (p_partkey // 2) AS link FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY seed, step, spot) AS rn FROM l)
SELECT 'https://shop.example/list/' || (4 * seed) AS seed_url, link AS product_url FROM n WHERE rn = 1"""
)
def chain_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products over chains of four list pages; a product is its first seed's."""
    pages, seeds = _chains(spark, sf_dir)
    return E.seed_links(pages, seeds)


def _chains(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    link = "concat('<a class=\"search-results-product-name\" href=\"/p/', p_partkey div 2, '\">')"
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey div 10 AS page", f"{link} AS l")
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "l"))), lambda x: x["l"]), "")
    more = F.expr("CASE WHEN page % 4 < 3 THEN concat('<a class=\"see-more-button\" data-url=\"/list/', page + 1, '\">') ELSE '' END")
    pages = rows.groupBy("page").agg(body.alias("body")).select(F.expr("concat('https://shop.example/list/', page)").alias("url"), F.concat("body", more).alias("html"))
    seeds = table(spark, sf_dir, "part").selectExpr("p_partkey div 40 AS pos").distinct().selectExpr("concat('https://shop.example/list/', 4 * pos) AS seed_url", "pos")
    return pages, seeds


@query("SELECT DISTINCT 'https://shop.example/list/' || (4 * (p_partkey // 40)) AS seed_url FROM part WHERE p_partkey // 40 % 3 = 1")
def seeds_without_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, seeds = _chains(spark, sf_dir)
    links = E.seed_links(pages, seeds.where("pos % 3 <> 1"))
    return E.failed_seeds(seeds, links).select("seed_url")


_FILE = "lower(regexp_extract(u, '([^/?]*)[?]', 1))"


@query(
    f"""WITH i AS (SELECT p_partkey AS k, i, 'https://{H.IMAGE_HOST}/a/' || CASE i WHEN 0 THEN p_partkey || '_RED_1.jpg' WHEN 1 THEN p_partkey || '_000_2.jpg' WHEN 2 THEN p_partkey || '_BLU_3.jpg' WHEN 3 THEN p_partkey || '_RED.jpg' ELSE p_partkey || '_red_0.jpg' END || '?sfrm=' || CASE WHEN i = 1 THEN 'jpg' ELSE 'png' END AS u FROM part, range(5) r(i))
SELECT k, string_agg(u, ' ' ORDER BY i) AS images, max(CASE WHEN i = 3 AND k % 2 = 0 THEN u END) AS hero,
  string_agg(u, ' ' ORDER BY CASE WHEN i = 1 THEN 0 ELSE 1 END, regexp_extract(u, '([^/?]*)[?]', 1)) FILTER (i IN (0, 1, 4)) AS gallery FROM i WHERE i <> 3 OR k % 2 = 0 GROUP BY k"""
)
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of src, data-src and srcset of one host, cleaned; the hero of a colour, and its gallery without it."""
    at = lambda name, rest="": f"'{IMAGES}/a/', p_partkey, '{name}{rest}'"
    html = f"""concat('<img src="', {at("_RED_1.jpg", "?sw=800")}, '"><img data-src="', {at("_000_2.jpg", "?sw=9&amp;sfrm=jpg")}, '"><source srcset="', {at("_BLU_3.jpg")}, ' 1x, ', {at("_BLU_3.jpg", "?sh=2")}, ' 2x"><img src="https://else.example/', p_partkey, '_RED_9.jpg">',
      CASE WHEN p_partkey % 2 = 0 THEN concat('<img src="', {at("_RED.jpg")}, '">') ELSE '' END, '<img data-srcset="', {at("_red_0.jpg")}, ' 3x">')"""
    pages = _pages(spark, sf_dir, "'u'", html).select("k", H.image_urls(F.col("html")).alias("i"))
    model, color = F.col("k").cast("string"), F.lit("RED")
    hero = H.hero_image(F.col("i"), model, color)
    return pages.select("k", F.array_join("i", " ").alias("images"), hero.alias("hero"), F.array_join(H.color_images(F.col("i"), model, color, hero), " ").alias("gallery"))


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'OWN' WHEN 1 THEN 'SEL' WHEN 2 THEN 'ANY 1' ELSE '' END AS color, 'https://shop.example/search?q=' || replace(p_brand, '#', '%23') AS search,
  'https://shop.example/v?pid=' || p_partkey || '&dwvar_' || p_partkey || '_color=RED' || CASE WHEN p_partkey % 2 = 0 THEN '&dwvar_' || p_partkey || '_size=M' ELSE '' END || '&quantity=1' AS variation,
  'https://cdn.example/k/' || p_partkey || '.jpg' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '?v=' || md5(p_name)[1:12] END AS versioned, 'https://cdn.example/k/' || p_partkey || '.jpg' AS plain,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'https://shop.example/product/y-' || p_partkey || '/' || p_partkey || '.html' END AS found FROM part"""
)
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = "concat('https://h.example/p/', p_partkey, '.html?', CASE p_partkey % 4 WHEN 0 THEN concat('dwvar_9_color=OTHER&amp;dwvar_', p_partkey, '_color=OWN') WHEN 1 THEN 'selectedColor=SEL&x=1' WHEN 2 THEN 'dwvar_8_color=ANY%201' ELSE 'x=1' END)"
    html = "concat('<a href=\"/product/x/1', p_partkey, '.html\">', CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('<a href=\"/product/y-', p_partkey, '/', p_partkey, '.html\">') END)"
    pages = _pages(spark, sf_dir, url, html, "p_brand", "p_name")
    k = F.col("k").cast("string")
    key = F.concat(F.lit("k/"), k, F.lit(".jpg"))
    whole = U.versioned("https://cdn.example", key, F.when(F.col("k") % 3 != 0, U.content_hash(F.col("p_name").cast("binary"))))
    return pages.select(
        "k",
        U.color_of(F.col("url"), k).alias("color"),
        U.search_url(SITE, F.col("p_brand")).alias("search"),
        U.variation_url(F.lit(SITE + "/v"), k, F.lit("RED"), F.when(F.col("k") % 2 == 0, "M")).alias("variation"),
        whole.alias("versioned"),
        U.unversioned(whole).alias("plain"),
        H.product_link(F.col("html"), k, SITE).alias("found"),
    )


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size + 1 ELSE p_size + 2 END AS n, 'in ' || p_name AS cut FROM part")
def json_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON that sits in <pre>, in the body's text or is the page, and the text between two marks."""
    data = lambda d: f"""concat('{{"n":', p_size + {d}, '}}')"""
    html = f"CASE p_partkey % 3 WHEN 0 THEN concat('<html><body><pre>', replace({data(0)}, chr(34), '&quot;'), '</pre></body>') WHEN 1 THEN concat('<html><body> <div>', {data(1)}, '</div> </body></html>') ELSE {data(2)} END"
    pages = _pages(spark, sf_dir, "concat('head [from]in ', p_name, '[to] tail')", html)
    return pages.select("k", F.get_json_object(H.browser_json(F.col("html")), "$.n").cast("int").alias("n"), F.replace(H.region(F.col("url"), "[from]", "[to]"), F.lit("[from]"), F.lit("")).alias("cut"))


@query(
    """WITH s AS (SELECT p_partkey AS k, p_brand || '-' || split_part(p_name, ' ', 1) || '-' || p_size AS sku, CASE WHEN p_partkey % 4 = 0 THEN 'product page not found' WHEN p_partkey % 4 = 1 THEN 'fail-over page' ELSE '' END AS note, 1 + p_size % 3 AS n FROM part)
SELECT k, sku, note, CASE WHEN note = 'product page not found' THEN 0 ELSE n END AS stores, (SELECT max(n) FROM s WHERE note <> 'product page not found') AS most FROM s"""
)
def store_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store rows of SKUs with their pages, one page an item; the widest row gives the number of columns."""
    sku = "concat_ws('-', p_brand, split_part(p_name, ' ', 1), p_size)"
    p = _spread_parts(spark, sf_dir, True).selectExpr("p_partkey AS k", f"{sku} AS full", "p_size")
    skus = p.selectExpr("k", "concat(k, '-x-', split_part(full, '-', 1)) AS sku", "full")
    card = lambda n: f"""'<div class="card-body"><div class="col store-name"><a>{n}</a></div><i class="dot in"></i></div>'"""
    pad = "CASE WHEN k % 4 = 1 THEN '' ELSE repeat('<!-- -->', 4000) END"
    cards = f"concat({card('A')}, CASE WHEN p_size % 3 > 0 THEN {card('B')} ELSE '' END, CASE WHEN p_size % 3 > 1 THEN {card('C')} ELSE '' END)"
    pages = p.where("k % 4 <> 0").selectExpr("cast(k AS string) AS item", "concat('u', k) AS url", f"""concat('class="results__stores"', {cards}, {pad}) AS html""")
    rows = K.store_rows(skus, pages)
    wide = K.wide(rows)
    most = len([c for c in wide.columns if c.startswith("shop")])
    own = rows.select(F.col("sku").alias("_sku"), F.size("stores").alias("stores"), "note")
    return skus.join(own, F.col("sku") == F.col("_sku")).select("k", F.col("full").alias("sku"), "note", "stores", F.lit(most).alias("most"))
