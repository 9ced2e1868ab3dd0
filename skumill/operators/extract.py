"""Product-variant tables from stored pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import html as H
from ..functions import price as M
from ..functions import text as X
from ..functions import urls as U
from ..sources.sinks import written
from .bind import bound
from .dedupe import first_rows, union_first

_PRODUCT = "`@type` string, `@id` string, productGroupID string, name string, description string, brand string, color string, sku string, mpn string, size string, image string, offers string, price string, listPrice string, gtin13 string, gtin12 string, gtin string"
#: Markup by which grouped product pages are read, as patterns. Fixed values.
SWATCH = r"(?is)<button[^>]*product-swatch[^>]*>"
SIZE_INPUT = r'(?is)<input[^>]*name="size"[^>]*>'
WEIGHT_HEADING = r'(?is)<h3[^>]*content-feature__heading[^>]*>\s*重さ\s*</h3>\s*<[^>]+>(.*?)</'
WEIGHT_WORDS = r"(?i)(?:重量|weight)\s*[:：]?\s*([0-9.,]+\s*(?:kg|g|グラム))"
CARE = r'(?is)id="collapsible-2"[^>]*>(.*?)(?:id="collapsible-\d+"|</section|$)'
DIMENSION_TABLE = r'(?is)id="collapsible-0"[^>]*>.*?(<table.*?</table>)'
VARIATION_LINK = r'data-url="([^"]*Product-Variation[^"]*)"'
JSON_SCRIPT = r"(?is)<script[^>]*type=[\"']application/(?:ld\+)?json[\"'][^>]*>(.*?)</script>"
#: Bytes of objects in one Arrow batch of `nested_objects`.
JSON_BATCH = 4 << 20
_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]')

_LINKED = "array<struct<productInfo:struct<productName:string,sku:string,color:string,size:string>,attributes:struct<stockStatus:string>>>"


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good pages, failures (url, error)) of pages (url, status, html)."""
    marked = pages.withColumn("error", H.page_error(F.col("status"), F.col("html")))
    return marked.where("error is null").drop("error"), marked.where("error is not null").select("url", "error")


def list_links(pages: DataFrame, links=H.product_links) -> DataFrame:
    """(url, link, pos): the absolute links of list pages, first of each on its page."""
    raw = pages.select("url", F.posexplode(links(F.col("html"))).alias("pos", "_l"))
    found = raw.select("url", U.absolute(U.plain_url(F.col("_l")), F.col("url")).alias("link"), "pos")
    return first_rows(found, ["url", "link"], ["pos"])


def one_link_per_model(pages: DataFrame, base: str) -> DataFrame:
    """(url, model, link): the first canonical product link of each model on a category page."""
    raw = pages.select("url", F.posexplode(H.all_links(F.col("html"))).alias("pos", "_l")).where(F.col("_l").contains("/product/"))
    found = raw.select("url", U.canonical_product(F.col("_l"), base).alias("link"), "pos").withColumn("model", U.model_of(F.col("link"))).where("model <> ''")
    return first_rows(found, ["url", "model"], ["pos"]).select("url", "model", "link")


def page_chain(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed_url, url, step): the list pages that follow from each seed, until a page has no next or one that the seed has seen.

    Round r knows each seed's pages under 2^r steps and each page's 2^r-th next
    one, so a chain of n pages takes about log2(n) rounds, however long it is.
    """
    found = bound(pages.select("url", "html"), _l=U.plain_url(H.next_page(F.col("html"))))
    nexts = found.select("url", U.absolute(F.col("_l"), F.col("url")).alias("next_url")).where("next_url is not null and next_url <> url")
    jump = written(nexts.distinct(), "chain-jumps")
    chain = written(seeds.select("seed_url", F.col("seed_url").alias("url"), F.lit(0).alias("step")).distinct(), "chain")
    leap = 1
    while True:
        ahead = chain.join(jump, "url").select("seed_url", F.col("next_url").alias("url"), (F.col("step") + leap).alias("step"))
        ahead = ahead.groupBy("seed_url", "url").agg(F.min("step").alias("step"))
        new = written(ahead.join(chain, ["seed_url", "url"], "left_anti"), "chain-new")
        if new.isEmpty():
            return chain
        chain = written(chain.unionByName(new), "chain")
        far = jump.select("url", F.col("next_url").alias("_mid")).join(jump.toDF("_mid", "next_url"), "_mid")
        jump, leap = written(far.select("url", "next_url").distinct(), "chain-jumps"), 2 * leap


def seed_links(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed_url, product_url): the products of every seed over its chain of pages; the first seed of a product wins.

    `seeds` is (seed_url, pos).
    """
    chain = page_chain(pages, seeds).join(seeds.select("seed_url", F.col("pos").alias("_seed")), "seed_url")
    found = chain.join(list_links(pages), "url").withColumnRenamed("pos", "_at")
    return first_rows(found, ["link"], ["_seed", "step", "_at"]).select("seed_url", F.col("link").alias("product_url"))


def failed_seeds(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """Seeds that yielded no product."""
    return seeds.join(links.select("seed_url").distinct(), "seed_url", "left_anti")


def _own_prices(satellite: Column) -> Column:
    """array<struct<sku, msrp, discounted_price>> of the variants in the satellite data, whose list may be an object; null without one."""
    text = F.get_json_object(satellite, "$.linkedProduct")
    kind = "struct<sku:string,productInfo:struct<sku:string>,price:string>"
    many = F.when(text.startswith("["), F.from_json(text, f"array<{kind}>")).otherwise(F.map_values(F.from_json(text, f"map<string,{kind}>")))

    def one(v: Column) -> Column:
        listed, shown = _two_prices(v["price"])
        sku = F.coalesce(X.nonblank(X.clean_text(v["sku"])), X.nonblank(X.clean_text(v["productInfo"]["sku"])))
        return F.struct(sku.alias("sku"), listed.alias("msrp"), M.differing(shown, listed).alias("discounted_price"))

    return F.filter(F.transform(many, one), lambda v: v["sku"].isNotNull())


def variant_prices(pages: DataFrame) -> DataFrame:
    """(url, sku, msrp, discounted_price) of the variants in the satellite data of each page; of a repeated SKU the last counts."""
    own = bound(pages.select("url", H.satellite(F.col("html")).alias("_sat")), _own=_own_prices(F.col("_sat")))
    later = lambda v, i: ~F.exists(F.slice("_own", i + 2, F.size("_own")), lambda w: w["sku"] == v["sku"])
    return own.select("url", F.inline(F.filter("_own", later)))


def _two_prices(price: Column) -> tuple[Column, Column]:
    of = lambda key: F.coalesce(X.nonblank(M.price_text(F.get_json_object(price, f"$.{key}"))), M.price_of_json(price))
    return of("displayRegularPrice"), of("displayPrice")


def variant_rows(pages: DataFrame, brand: str, image_root: str) -> tuple[DataFrame, DataFrame]:
    """(rows of VARIANT, failures): from the data layer, else from JSON-LD, else one bare row a page.

    A page whose data layer is no JSON fails.  Rows of a page that agree in
    colour, size and stock are one, the first.  Every page is parsed once, in its
    own row; nothing is shuffled.
    """
    raw = pages.select(
        "url",
        "html",
        H.data_layer(F.col("html")).alias("_data"),
        H.satellite(F.col("html")).alias("_sat"),
    )
    parsed = bound(raw, _dl=F.from_json("_data", f"productInfo struct<productID:string,productName:string>, price string, linkedProduct {_LINKED}"))
    bad = (F.col("_data").isNotNull() & F.try_parse_json("_data").isNull()) | (F.col("_sat").isNotNull() & F.try_parse_json("_sat").isNull())
    failed = parsed.where(bad).select("url", F.lit("malformed data layer").alias("error"))
    good = parsed.where(~bad)
    color = U.color_of(F.col("url"))
    good = bound(good, _color=color)
    color = F.col("_color")
    good = good.select(
        "url",
        "_dl",
        "_sat",
        H.category(F.col("html")).alias("type"),
        H.title(F.col("html")).alias("_title"),
        H.model(F.col("html"), F.col("url"), F.col("_data")).alias("model"),
        H.style_code(F.col("html"), color, image_root).alias("u_model"),
        H.json_objects(H.json_blocks(F.col("html")), _PRODUCT).alias("_ld"),
    )
    good = bound(good, _ld=F.col("_ld"), model=F.col("model"), _title=F.col("_title"))
    listed, shown = _two_prices(F.col("_dl.price"))
    good = bound(good, _listed=listed, _shown=shown, _page_title=F.coalesce(X.nonblank(U.decoded(F.col("_dl.productInfo.productName"))), F.col("_title")))
    listed, shown, page_title = F.col("_listed"), F.col("_shown"), F.col("_page_title")
    clean = lambda c: F.coalesce(X.clean_text(c), F.lit(""))

    def from_layer(v: Column) -> Column:
        stock = F.coalesce(F.trim(v["attributes"]["stockStatus"]), F.lit(""))
        return F.struct(
            F.coalesce(X.nonblank(U.decoded(v["productInfo"]["productName"])), page_title).alias("title"),
            clean(v["productInfo"]["color"]).alias("color"),
            clean(v["productInfo"]["size"]).alias("size"),
            listed.alias("msrp"),
            M.differing(shown, listed).alias("discounted_price"),
            stock.alias("stock_status"),
            clean(v["productInfo"]["sku"]).alias("sku"),
        )

    def from_ld(v: Column) -> Column:
        return F.struct(
            F.coalesce(X.nonblank(clean(v["name"])), F.col("_title")).alias("title"),
            clean(v["color"]).alias("color"),
            clean(v["size"]).alias("size"),
            M.price_text(F.coalesce(H.offer_field(v["offers"], "price"), v["price"])).alias("msrp"),
            F.lit("").alias("discounted_price"),
            X.stock_word(F.coalesce(F.trim(H.offer_field(v["offers"], "availability")), F.lit(""))).alias("stock_status"),
            F.lit("").alias("sku"),
        )

    empty = F.array().cast("array<struct<title:string,color:string,size:string,msrp:string,discounted_price:string,stock_status:string,sku:string>>")
    layer = F.coalesce(F.transform(F.filter("_dl.linkedProduct", lambda v: v.isNotNull()), from_layer), empty)
    ours = F.filter("_ld", lambda o: (o["@type"] == "Product") & ((F.col("model") == "") | F.coalesce(H.offer_field(o["offers"], "url"), F.lit("")).contains(F.col("model"))))
    ld = F.coalesce(F.transform(ours, from_ld), empty)
    bare = F.array(F.struct(F.col("_title").alias("title"), *[F.lit("").alias(c) for c in ("color", "size", "msrp", "discounted_price", "stock_status", "sku")]))
    good = bound(good, _layer=layer, _from_ld=ld, _own=_own_prices(F.col("_sat")))
    chosen = F.when(F.size("_layer") > 0, F.col("_layer")).when(F.size("_from_ld") > 0, F.col("_from_ld")).otherwise(bare)
    good = bound(good, _rows=chosen)
    good = bound(good, _keys=F.transform("_rows", lambda v: F.struct(v["color"], v["size"], v["stock_status"])))
    firsts = F.filter(F.transform("_rows", lambda v, i: F.struct(i.alias("pos"), v.alias("v"))), lambda x: F.array_position("_keys", F.struct(x["v"]["color"], x["v"]["size"], x["v"]["stock_status"])) == x["pos"] + 1)
    rows = good.select("url", "type", "model", "u_model", "_own", F.inline(firsts)).select("url", "type", "model", "u_model", "_own", "pos", "v.*")
    rows = bound(rows, _price=F.when(F.col("sku") != "", F.try_element_at(F.filter("_own", lambda o: o["sku"] == F.col("sku")), F.lit(-1))))
    for c in ("msrp", "discounted_price"):
        rows = rows.withColumn(c, F.when(F.col("_price").isNotNull(), F.col(f"_price.{c}")).otherwise(F.col(c)))
    return rows.select(*[F.lit(brand).alias(c) if c == "brand" else M.stock_quantity(F.col("stock_status")).alias(c) if c == "quantity" else F.col(c) for c in S.VARIANT_COLUMNS], "pos"), failed


def product_pages(pages: DataFrame, base: str, brand: str) -> tuple[DataFrame, DataFrame]:
    """(products, failures) of grouped product pages: one row a page with its nested colours.

    A page without a ProductGroup is a failure; `generic_products` reads those.
    Every page is parsed once, in its own row; nothing is shuffled.
    """
    h = F.col("html")
    raw = bound(pages.select("url", "html"), _o=H.json_objects(H.json_blocks(h), _PRODUCT))
    raw = bound(raw, _g=F.get(F.filter("_o", lambda o: o["@type"] == "ProductGroup"), F.lit(0)))
    failed = raw.where("_g is null").select("url", F.lit("no ProductGroup").alias("error"))
    text = X.one_space(F.regexp_replace(F.regexp_replace(h, r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]+>", " "))
    good = bound(
        raw.where("_g is not null"),
        model=F.coalesce(X.nonblank(F.col("_g.productGroupID")), F.regexp_replace("_g.@id", "^#+", ""), F.lit("")),
        _allowed=F.coalesce(F.from_json("_g.color", "array<string>"), F.array().cast("array<string>")),
        images=H.image_urls(h),
        _text=text,
    )
    good = bound(good, _items=F.transform(F.filter("_o", lambda o: o["@type"] == "Product"), lambda o: F.struct(H.variant_color(o, F.col("model"), F.transform("_allowed", X.one_space)).alias("code"), o.alias("item"))))
    good = bound(good, _codes=F.transform("_items", lambda i: i["code"]), _page_price=M.first_yen(F.col("_text")))
    # an element a colour: a swatch each, or the schema's own colours where a page has no swatches
    swatch = F.transform(
        F.regexp_extract_all(h, F.lit(SWATCH), F.lit(0)),
        lambda t: F.struct(H.swatch_color(t, F.col("model"), F.col("_codes")).alias("code"), t.alias("tag")),
    )
    swatch = F.filter(swatch, lambda s: s["code"].isNotNull())
    from_schema = F.transform(F.array_distinct("_codes"), lambda c: F.struct(c.alias("code"), F.lit("").alias("tag")))
    good = bound(good, _swatches=swatch, _fall=F.transform(F.regexp_extract_all(h, F.lit(SIZE_INPUT), F.lit(0)), lambda t: H.attribute(t, "value")))
    good = bound(good, _sw=F.when(F.size("_swatches") > 0, F.col("_swatches")).otherwise(from_schema))
    no_code = lambda c: F.coalesce(c["code"], F.lit("\x00"))
    good = bound(good, _named=F.transform("_sw", no_code))
    # of a repeated colour the first swatch counts, and its last item
    strings = lambda tag, name: F.coalesce(F.from_json(H.attribute(tag, name), "array<string>"), F.array().cast("array<string>"))
    colors = F.filter(F.transform("_sw", lambda c, i: F.struct(i.alias("pos"), c.alias("c"))), lambda x: F.array_position("_named", no_code(x["c"])) == x["pos"] + 1)
    good = bound(good, _colors=colors)
    read = lambda x: F.struct(
        x["pos"].alias("pos"),
        x["c"]["code"].alias("code"),
        F.try_element_at(F.filter("_items", lambda i: i["code"] == x["c"]["code"]), F.lit(-1))["item"].alias("i"),
        X.one_space(H.attribute(x["c"]["tag"], "data-caption")).alias("caption"),
        strings(x["c"]["tag"], "data-size-stock").alias("has"),
        strings(x["c"]["tag"], "data-size-oos").alias("lacks"),
        F.coalesce(F.from_json(H.attribute(x["c"]["tag"], "data-product-oos"), "map<string,string>"), F.create_map().cast("map<string,string>")).alias("oos"),
    )
    good = bound(good, _colors=F.transform("_colors", read))
    spec_of = lambda i: F.coalesce(F.get_json_object(i["offers"], "$.priceSpecification.price"), F.get_json_object(i["offers"], "$.priceSpecification[0].price"), i["listPrice"])
    priced = lambda x: F.struct(
        x.alias("c"),
        F.coalesce(X.nonblank(H.offer_field(x["i"]["offers"], "price")), F.col("_page_price")).alias("sale"),
        spec_of(x["i"]).alias("spec"),
        F.coalesce(X.nonblank(x["i"]["image"]), H.offer_field(x["i"]["offers"], "image")).alias("img"),
        X.one_space(x["i"]["size"]).alias("size"),
        F.array_distinct(F.filter(F.concat("_fall", x["has"], x["lacks"], F.map_keys(x["oos"])), lambda s: s.isNotNull())).alias("sizes"),
    )
    good = bound(good, _colors=F.transform("_colors", priced))
    pair = lambda k, v: F.when((F.coalesce(k, F.lit("")) != "") & (F.coalesce(v, F.lit("")) != ""), F.create_map(k, v)).otherwise(F.create_map().cast("map<string,string>"))

    def color(x: Column) -> Column:
        c, i = x["c"], x["c"]["i"]
        image = F.when(x["img"].startswith("["), F.get_json_object(x["img"], "$[0]")).otherwise(x["img"])
        return F.struct(
            c["pos"].alias("pos"),
            c["code"].alias("code"),
            F.coalesce(X.nonblank(c["caption"]), X.one_space(i["color"]), F.lit("")).alias("name"),
            F.when(F.size(x["sizes"]) > 0, x["sizes"]).otherwise(F.array(F.lit(""))).alias("sizes"),
            c["has"].alias("in_stock_sizes"),
            c["oos"].alias("out_of_stock_upcs"),
            pair(x["size"], X.one_space(F.coalesce(X.nonblank(i["sku"]), i["mpn"]))).alias("sku_by_size"),
            pair(x["size"], X.one_space(F.coalesce(i["gtin13"], i["gtin12"], i["gtin"]))).alias("upc_by_size"),
            F.coalesce(U.clean_image(image, H.IMAGE_HOST), F.lit("")).alias("main_image"),
            U.canonical_product(F.coalesce(X.nonblank(H.offer_field(i["offers"], "url")), F.col("url")), base).alias("color_url"),
            x["sale"].alias("offer_price"),
            F.coalesce(x["spec"], x["sale"]).alias("msrp"),
            F.when(x["spec"].isNotNull() & (x["spec"] != x["sale"]), x["sale"]).alias("discounted_price"),
        )

    good = bound(good, colors=F.transform("_colors", color))
    weight = F.coalesce(
        X.nonblank(X.one_space(F.regexp_replace(F.regexp_extract(h, WEIGHT_HEADING, 1), "<[^>]+>", " "))),
        X.nonblank(F.regexp_extract("_text", WEIGHT_WORDS, 1)),
        F.lit(""),
    )
    care = F.split(F.regexp_replace(F.regexp_extract(h, CARE, 1), "<[^>]+>", "\n"), "\n")
    maker = F.when(F.col("_g.brand").startswith("{"), F.get_json_object("_g.brand", "$.name")).otherwise(F.col("_g.brand"))
    products = good.select(
        "url",
        X.one_space(F.coalesce("_g.name", F.lit(""))).alias("title"),
        "model",
        F.coalesce(X.nonblank(F.lower(X.one_space(maker))), F.lit(brand)).alias("brand"),
        X.one_space(F.coalesce("_g.description", F.lit(""))).alias("description"),
        X.plain_table(F.regexp_extract(h, DIMENSION_TABLE, 1)).alias("dimension"),
        X.material_text(care).alias("material"),
        X.metric_weight(weight).alias("weight"),
        "images",
        F.when(F.size("colors") > 0, F.col("colors")).alias("colors"),
        M.displayed_price(h, "sales").alias("display_price"),
        M.displayed_price(h, "strike-through list").alias("display_list_price"),
        F.regexp_replace(H.unescaped(X.extract(h, VARIATION_LINK)), r"\?.*$", "").alias("variation_endpoint"),
    )
    return products, failed


def catalogue_rows(products: DataFrame, variation: DataFrame, base: str, cap: int = 5) -> DataFrame:
    """Rows of CATALOGUE (and pos): colour x size, with live stock and price where `variation` has them.

    variation: (model, color, size, ats, list, sales); its rows of a colour meet a
    page's colour once, and of a repeated size the least counts.  Prices: live, else shown
    in the page, else structured data with tax; an ALL size is written blank.
    """
    live = F.sort_array(F.collect_list(F.struct("size", "ats", "list", "sales")))
    v = variation.groupBy(F.col("model").alias("_vm"), F.col("color").alias("_vc")).agg(live.alias("_live"))
    c = products.select("*", F.explode("colors").alias("c")).withColumn("_code", F.col("c.code"))
    c = c.join(v, (F.col("model") == F.col("_vm")) & (F.col("_code") == F.col("_vc")), "left")

    def asked(size: Column, i: Column) -> Column:
        wanted = (i == 0) | (F.array_contains("c.in_stock_sizes", size) & ~F.map_contains_key("c.out_of_stock_upcs", size))
        return F.struct(i.alias("size_pos"), size.alias("_size"), F.when(wanted, F.get(F.filter("_live", lambda o: o["size"] == size), F.lit(0))).alias("_v"))

    c = bound(c, _sizes=F.transform("c.sizes", asked))
    # a colour's price: its first size, in order, for which the lookup gave one
    known = F.get(F.filter("_sizes", lambda x: x["_v"]["list"].isNotNull() | x["_v"]["sales"].isNotNull()), F.lit(0))["_v"]
    c = bound(c, _known=known)
    c = c.withColumn("_p", F.when(F.col("_known").isNotNull(), F.struct(F.coalesce("_known.list", "_known.sales").alias("l"), F.col("_known.sales").alias("s"))))
    rows = c.select("*", F.inline("_sizes")).withColumn("ats", F.col("_v.ats"))
    shown = F.coalesce("display_list_price", "display_price")
    listed = F.when(F.col("_p").isNotNull(), M.yen(F.col("_p.l"))).when(F.col("display_price").isNotNull(), M.yen(shown)).otherwise(M.yen(M.with_tax(F.coalesce(X.nonblank(F.col("c.msrp")), F.col("c.offer_price")))))
    sold = (
        F.when(F.col("_p").isNotNull(), F.when(F.col("_p.s").isNotNull() & (F.col("_p.s") != F.col("_p.l")), M.yen(F.col("_p.s"))).otherwise(""))
        .when(F.col("display_price").isNotNull(), F.when(F.col("display_list_price").isNotNull() & (F.col("display_price") != F.col("display_list_price")), M.yen(F.col("display_price"))).otherwise(""))
        .otherwise(M.yen(M.with_tax(F.col("c.discounted_price"))))
    )
    out_size = F.when(F.upper(F.trim("_size")) == "ALL", "").otherwise(F.col("_size"))
    in_stock = F.array_contains("c.in_stock_sizes", F.col("_size")) & ~F.map_contains_key("c.out_of_stock_upcs", F.col("_size"))
    quantity = M.live_quantity(in_stock, F.col("ats"), cap)
    upc = F.coalesce(F.try_element_at("c.upc_by_size", F.col("_size")), F.try_element_at("c.out_of_stock_upcs", F.col("_size")), F.lit(""))
    rows = bound(rows, _main=F.coalesce(H.hero_image(F.col("images"), F.col("model"), F.col("_code")), X.nonblank(F.col("c.main_image")), F.get("images", F.lit(0)), F.lit("")))
    rows = bound(rows, _out_size=out_size, _quantity=quantity, _upc=upc, _listed=listed, _sold=sold)
    listed, sold = F.col("_listed"), F.col("_sold")
    main, out_size, quantity, upc = (F.col(c) for c in ("_main", "_out_size", "_quantity", "_upc"))
    made = {
        "sku": F.when(out_size != "", F.coalesce(F.try_element_at("c.sku_by_size", F.col("_size")), F.concat_ws("-", "model", "_code", out_size))).otherwise(F.concat_ws("-", "model", "_code")),
        "upc_barcode_ean": F.lit(""),
        "size": out_size,
        "url": U.variant_url(F.coalesce(X.nonblank(F.col("c.color_url")), F.col("url")), F.col("model"), F.col("_code"), upc, base),
        "color": F.col("_code"),
        "msrp": listed,
        "discounted_price": sold,
        "product_main_image": main,
        "product_other_image": F.array_join(H.color_images(F.col("images"), F.col("model"), F.col("_code"), main), "\n"),
        "product_spec": F.lit(""),
        "stock_status": F.when(quantity > 0, "在庫あり").otherwise("在庫なし"),
        "quantity": quantity.cast("string"),
    }
    return rows.select(*[F.coalesce(made.get(c, F.col(c)), F.lit("")).alias(c) for c in S.CATALOGUE_COLUMNS], F.col("url").alias("page_url"), F.col("c.pos").alias("color_pos"), "size_pos")


def _object_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of every object of a JSON text, in the order of their starts; none where it is malformed."""
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return []
    spans, opened = [], []
    for token in _JSON_TOKEN.finditer(text):
        if token[0] == "{":
            opened.append(token.start())
        elif token[0] == "}":
            spans.append((opened.pop(), token.end()))
    return sorted(spans)


def nested_objects(pages: DataFrame) -> DataFrame:
    """(url, pos, object VARIANT): every JSON object of a page's JSON scripts, at any level.

    pos is the script's number and the object's among its objects, in the order in
    which they begin.  A malformed script has no objects; one that nests deeper than
    Python's reader follows (some thousands of levels) counts as malformed.  An
    object that a VARIANT cannot hold is null.
    """
    scripts = F.regexp_extract_all("html", F.lit(JSON_SCRIPT), F.lit(1))
    kinds = [pa.string(), pa.list_(pa.int32()), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["url", "pos", "_text"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for url, script, text in zip(*(batch.column(c) for c in range(3)), strict=True):
                url, script, text = url.as_py(), script.as_py(), text.as_py()
                for n, (a, b) in enumerate(_object_spans(text)):
                    rows.append((url, [script, n], text[a:b]))
                    size += b - a + 64
                    if size > JSON_BATCH:
                        yield batch_of(rows)
                        rows, size = [], 0
            yield batch_of(rows)

    texts = pages.select(F.col("url").cast("string").alias("url"), F.posexplode(scripts).alias("_k", "_t")).mapInArrow(walk, "url string, pos array<int>, _text string")
    return texts.select("url", "pos", F.try_parse_json("_text").alias("object"))


def generic_products(pages: DataFrame, brand: str) -> DataFrame:
    """(url, model, title, brand, color, sizes, skus, upcs, msrp, discounted_price, image): one row a colour, for pages without a group.

    Product objects with a number or a colour are the variants, or all product
    objects where none has one.  Of a colour, sizes are kept in order and the last
    price, URL and image count.
    """
    get = lambda path: F.try_variant_get("object", path, "string")
    objects = nested_objects(pages).select("url", "pos", get("$['@type']").alias("type"), *[get(f"$.{n}").alias(n) for n in ("name", "productGroupID", "sku", "mpn", "color", "size", "gtin13", "gtin12", "gtin", "listPrice", "image", "offers", "brand")])
    items = objects.where("type = 'Product'").withColumn("_named", F.expr("coalesce(sku, mpn, color) is not null"))
    any_named = items.groupBy("url").agg(F.bool_or("_named").alias("_any"))
    items = items.join(any_named, "url").where("_named or not _any")
    group = objects.where("type in ('Product', 'ProductGroup')").groupBy("url").agg(F.min_by(F.struct("productGroupID", "mpn", "name", "brand"), "pos").alias("_g"))
    raw_model = F.coalesce("_g.productGroupID", "_g.mpn", U.model_of(F.col("url")))
    items = items.join(group, "url").withColumn("model", F.coalesce(X.nonblank(F.regexp_extract(raw_model, r"\d{4,7}", 0)), raw_model))
    number = F.coalesce("sku", "mpn", F.lit(""))
    code = H.variant_color(F.struct("mpn", "sku", "offers", "color"), F.col("model"), F.array().cast("array<string>"))
    sale = H.offer_field(F.col("offers"), "price")
    listed = F.coalesce(H.offer_field(F.col("offers"), "highPrice"), F.col("listPrice"))
    items = items.select(
        "url",
        "pos",
        "model",
        F.coalesce(X.one_space(F.col("_g.name")), F.lit("")).alias("title"),
        F.lower(F.coalesce(F.when(F.col("_g.brand").startswith("{"), F.get_json_object("_g.brand", "$.name")).otherwise(F.col("_g.brand")), F.lit(brand))).alias("brand"),
        F.coalesce(X.nonblank(code), X.nonblank(U.color_of(F.col("url"), F.col("model"))), F.lit("default")).alias("color"),
        X.nonblank(F.coalesce("size", F.get(F.split(number, "-"), F.lit(2)))).alias("size"),
        X.nonblank(number).alias("sku"),
        F.coalesce("gtin13", "gtin12", "gtin").alias("upc"),
        F.coalesce(listed, sale).alias("msrp"),
        F.when(listed.isNotNull() & (listed != sale), sale).alias("discounted_price"),
        U.clean_image(F.when(F.col("image").startswith("["), F.get_json_object("image", "$[0]")).otherwise(F.coalesce("image", F.lit(""))), H.IMAGE_HOST).alias("image"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("pos", "size", "sku", "upc")))
    folded = items.groupBy("url", "model", "title", "brand", "color").agg(ordered.alias("_l"), F.max_by("msrp", "pos").alias("msrp"), F.max_by("discounted_price", "pos").alias("discounted_price"), F.max_by("image", "pos").alias("image"))
    sized = F.filter("_l", lambda x: x["size"].isNotNull())
    pairs = lambda field: F.filter(F.transform(sized, lambda x: F.struct(x["size"].alias("k"), x[field].alias("v"))), lambda p: p["v"].isNotNull())
    last = lambda field: F.map_from_entries(F.filter(pairs(field), lambda p, i: ~F.exists(F.slice(pairs(field), i + 2, F.size(pairs(field))), lambda q: q["k"] == p["k"])))
    return folded.select("url", "model", "title", "brand", "color", F.array_distinct(F.transform(sized, lambda x: x["size"])).alias("sizes"), last("sku").alias("skus"), last("upc").alias("upcs"), "msrp", "discounted_price", "image")


def merge_rows(*tables: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Finished and new rows together; the earlier table's row of a key stays."""
    return union_first(tables, keys, order)
