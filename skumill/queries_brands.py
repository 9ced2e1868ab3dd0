"""Queries of the brand profiles: specifications that Spark composes from part and lineitem, read back by each profile.

The SQL sees the parts that a specification was made of and never the specification
itself, so a match shows that the profile has read it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import reconcile as R
from .plans.profiles import profile
from .queries import _BID, _LINE_ORDER
from .registry import query, registered_sql, table


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, sku_id, k, size, word, d (the brand's digits) and prices of each line item.

    The first row of a line item by `_LINE_ORDER` has its least part, and its price is in
    the least tuple of the leading columns up to it; nulls come last, as in the SQL.
    """
    leading = _LINE_ORDER[: _LINE_ORDER.index("l_extendedprice") + 1]
    least = F.min(F.struct(*[x for c in leading for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), least["l_extendedprice"].alias("l_extendedprice"))
    rows = lines.join(table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand", "p_name", "p_size"), "l_partkey")
    return rows.selectExpr(
        "l_orderkey * 100 + l_linenumber AS pos", "l_partkey AS k", "p_size AS size", "split_part(p_name, ' ', 1) AS word", "substr(p_brand, 7) AS d",
        "l_extendedprice AS cost", "l_linenumber + 2 AS lead_time", "round(l_extendedprice * 2, 0) AS my_bid", "concat('S', cast(l_orderkey * 100 + l_linenumber AS string)) AS sku_id",
    )


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.selectExpr("p_partkey AS pos", "p_size AS size", "split_part(p_name, ' ', 1) AS word", "substr(p_brand, 7) AS d", "p_retailprice AS msrp", "p_retailprice * 0.9D AS discounted_price", "cast(p_partkey % 7 AS int) AS quantity")


_BASE = f"""lines AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1),
offers AS (SELECT l_orderkey * 100 + l_linenumber AS pos, l_partkey AS k, p_size AS size, split_part(p_name, ' ', 1) AS word, substr(p_brand, 7) AS d, l_extendedprice AS cost FROM lines JOIN part ON l_partkey = p_partkey),
goods AS (SELECT p_partkey AS pos, p_size AS size, split_part(p_name, ' ', 1) AS word, substr(p_brand, 7) AS d, p_retailprice AS msrp, p_retailprice * 0.9::DOUBLE AS discounted_price, CAST(p_partkey % 7 AS INTEGER) AS quantity FROM part)"""


def _match(o: str, s: str, color: str = "o.color = s.color", first: str = "") -> str:
    """First matches of offers (pos, model, color, z) and goods (the same); `first` holds further tables."""
    return f"WITH {_BASE}, {first}{',' if first else ''} o AS (SELECT pos, {o} FROM offers), s AS (SELECT pos, {s} FROM goods) SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND {color} AND o.z = s.z GROUP BY o.pos"


def _found(spark: SparkSession, sf_dir: str, name: str, offer: dict[str, str], good: dict[str, str], sheet: DataFrame | None = None) -> DataFrame:
    """First matches of a profile, with the listing's and the supply's columns given as SQL."""
    listing = offers(spark, sf_dir).selectExpr("pos", "sku_id", *[f"{v} AS {c}" for c, v in ({"product_name": "''"} | offer).items()])
    supply = goods(spark, sf_dir).selectExpr("pos", "msrp", "discounted_price", "quantity", *[f"{v} AS {c}" for c, v in good.items()])
    return R.first_match(listing, supply, profile(name), sheet).selectExpr("pos", "supply.pos AS supply_pos")


def _sides(spark: SparkSession, sf_dir: str, offer: dict[str, str], good: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Listing and supply of a brand with costs that often agree, models that are not there and stock that has run out."""
    offer = {"product_name": "''"} | offer | {"article": f"CASE WHEN k % 11 = 0 THEN 'none' ELSE {offer['article']} END"}
    cost = f"CASE WHEN k % 7 = 3 THEN NULL WHEN k % 7 = 5 THEN '-' ELSE format_number({_PRICE.format(k='k')}, 0) END AS cost"
    listing = offers(spark, sf_dir).selectExpr("pos", "sku_id", "lead_time", "my_bid", cost, *[f"{v} AS {c}" for c, v in offer.items()])
    price = f"cast({_PRICE.format(k='pos')} AS DOUBLE)"
    supply = goods(spark, sf_dir).drop("msrp", "discounted_price").selectExpr("pos", "quantity", f"{price} AS msrp", f"CASE WHEN pos % 2 = 0 THEN {price} - 500 END AS discounted_price", *[f"{v} AS {c}" for c, v in good.items()])
    return listing, supply


#: A price of a line item or part by its number and size, through all bid tiers.
_PRICE = "((1000 + 500 * ({k} % 3)) * CASE size % 3 WHEN 0 THEN 1 WHEN 1 THEN 20 ELSE 100 END)"


def _listing_sql(matches: str, multiplier: float, discounted: bool) -> str:
    """The reconciled listing, from the SQL of the first matches; models of every eleventh part are not there."""
    against = "coalesce(sale, m)" if discounted else "m"
    bid = _BID.format(c="c").replace("1.15", str(multiplier))
    return f"""WITH h AS ({matches}), {_BASE},
price AS (SELECT pos, quantity, CAST({_PRICE.format(k="pos")} AS DOUBLE) AS m, CASE WHEN pos % 2 = 0 THEN CAST({_PRICE.format(k="pos")} AS DOUBLE) - 500 END AS sale FROM goods),
o AS (
  SELECT offers.pos, k, offers.pos % 100 + 2 AS lead_time, round(cost * 2, 0) AS my_bid, CASE WHEN k % 7 IN (3, 5) THEN NULL ELSE CAST({_PRICE.format(k="k")} AS DOUBLE) END AS old FROM offers),
j AS (
  SELECT o.*, supply_pos IS NOT NULL AND k % 11 <> 0 AS hit, price.quantity, m, old IS NULL OR {against} <> old AS differs FROM o LEFT JOIN h ON o.pos = h.pos LEFT JOIN price ON supply_pos = price.pos),
f AS (SELECT *, CASE WHEN differs THEN m ELSE old END AS c FROM j)
SELECT pos, CASE WHEN k % 11 = 0 THEN '没有model匹配到，下架' WHEN NOT hit THEN '没有匹配到天猫的规格(颜色尺码)，下架'
  ELSE concat_ws(chr(10), CASE WHEN differs THEN '天猫价格和采购成本(JPY)不一致，已更新O列' END, CASE WHEN quantity = 0 THEN '没有库存，下架' END) END AS status,
  CASE WHEN hit THEN CAST(lead_time AS BIGINT) END AS new_lead_time, CASE WHEN hit THEN my_bid END AS new_bid, CASE WHEN hit THEN quantity END AS new_stock,
  CASE WHEN hit THEN c END AS cost, CASE WHEN hit AND differs THEN CAST(old AS BIGINT) END AS old_cost, CASE WHEN hit THEN {bid} END AS bid_price FROM f"""


def _supply_sql(matches: str, multiplier: float) -> str:
    """The reconciled supply: every model of it is listed, unless its every line item is of an eleventh part."""
    return f"""WITH h AS ({matches}), {_BASE},
taken AS (SELECT supply_pos, arg_max('S' || h.pos, h.pos) AS sku_id FROM h JOIN offers ON h.pos = offers.pos WHERE k % 11 <> 0 GROUP BY supply_pos),
price AS (SELECT pos, d, quantity, CAST({_PRICE.format(k="pos")} AS DOUBLE) - CASE WHEN pos % 2 = 0 THEN 500 ELSE 0 END AS c FROM goods)
SELECT price.pos, CASE WHEN sku_id IS NOT NULL THEN '匹配到' WHEN quantity <= 0 THEN '无需处理' WHEN EXISTS (SELECT 1 FROM offers WHERE offers.d = price.d AND k % 11 <> 0) THEN '该货号没有规格匹配到，得物上架' ELSE '上架' END AS status,
  {_BID.format(c="c").replace("1.15", str(multiplier))} AS bid_price, sku_id FROM price LEFT JOIN taken ON supply_pos = price.pos"""


def _reconciled(brand: str, sides: Callable[[], tuple[str, dict[str, str], dict[str, str]]]) -> None:
    """Register listing_<brand> and supply_<brand> over the matches of brand_<brand>."""
    name, offer, good = sides()
    used, matches = profile(name), registered_sql()[f"brand_{brand}"]

    def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
        got = R.reconcile_listing(*_sides(spark, sf_dir, offer, good), used)
        return got.selectExpr("pos", "status", "cast(new_lead_time AS bigint) AS new_lead_time", "new_bid", "new_stock", "CASE WHEN new_stock IS NOT NULL THEN cast(cost AS double) END AS cost", "old_cost", "bid_price")

    def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
        return R.reconcile_supply(*_sides(spark, sf_dir, offer, good), used).select("pos", "status", "bid_price", "sku_id")

    query(_listing_sql(matches, used.multiplier, used.compare_discounted), f"listing_{brand}")(listing)
    query(_supply_sql(matches, used.multiplier), f"supply_{brand}")(supply)


def _half(n: str, div: str) -> str:
    """20, 20.5 ... 29.5 by a number, as text; `div` is the dialect's whole division."""
    return f"CASE WHEN {n} % 2 = 0 THEN cast(20 + ({n} % 20) {div} 2 AS VARCHAR(9)) ELSE concat(cast(20 + ({n} % 20) {div} 2 AS VARCHAR(9)), '.5') END"


def _values(name: str, pairs: dict) -> str:
    return f"{name}(eu, jp) AS (VALUES {', '.join(f'({k}, {v!r})' for k, v in pairs.items())})"


# --- size lists ------------------------------------------------------------------


def _size_list_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = "CASE k % 3 WHEN 0 THEN concat('黑 SIZE XXXXL(', size, '（', size + 1, ')）') WHEN 1 THEN concat('黑1双装 SZIE ', size, '/', size + 2, '（XXXL)') ELSE concat('黑 JP ', size, ' x') END"
    return ("size_list", {"article": "concat('q', d)", "spec": spec}, {"model": "concat('Q', d)", "color": "'any'", "size": "CASE WHEN pos % 9 = 0 THEN '4XL' WHEN pos % 9 = 1 THEN '3XL' ELSE concat(size, '.0') END"})


@query(
    _match(
        "'Q' || d AS model, '' AS color, unnest(CASE k % 3 WHEN 0 THEN [CAST(size + 1 AS VARCHAR), '4XL'] WHEN 1 THEN [CAST(size AS VARCHAR), CAST(size + 2 AS VARCHAR), '3XL'] ELSE [CAST(size AS VARCHAR)] END) AS z",
        "'Q' || d AS model, '' AS color, CASE WHEN pos % 9 = 0 THEN '4XL' WHEN pos % 9 = 1 THEN '3XL' ELSE CAST(size AS VARCHAR) END AS z",
    )
)
def brand_size_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes in nested brackets of both widths, behind slashes, and by JP."""
    return _found(spark, sf_dir, *_size_list_sides())


@query(
    f"""WITH {_BASE}, p AS (SELECT o.pos, CASE WHEN o.k % 4 = 0 THEN '' ELSE o.word END AS c, CASE WHEN o.k % 6 = 0 THEN '' ELSE CAST(o.size AS VARCHAR) END AS z,
  CASE WHEN g.pos % 5 = 0 THEN '' ELSE g.word END AS sc, CASE WHEN g.pos % 8 = 0 THEN '' ELSE CAST(g.size AS VARCHAR) END AS sz FROM offers o JOIN goods g ON g.pos = o.k // 2)
SELECT pos, (c = sc AND z = sz) OR (c = '' AND sc = '' AND z = sz) OR (c = sc AND z = '' AND sz = '') AS fits FROM p"""
)
def three_way_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-way condition itself, on pairs of a line item and another part."""
    o = offers(spark, sf_dir).selectExpr("pos", "k div 2 AS g", "CASE WHEN k % 4 = 0 THEN '' ELSE word END AS c", "CASE WHEN k % 6 = 0 THEN NULL ELSE cast(size AS string) END AS z")
    g = goods(spark, sf_dir).selectExpr("pos AS g", "CASE WHEN pos % 5 = 0 THEN '' ELSE word END AS sc", "CASE WHEN pos % 8 = 0 THEN '' ELSE cast(size AS string) END AS sz")
    rows = o.join(g, "g")
    fits = R.three_way(rows.c, rows.z, rows.sc, rows.sz)
    return rows.select("pos", fits.alias("fits"))


# --- article with a colour behind its last hyphen, sizes by SIZE, JP and US -----


def _lettered_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = "concat('黑', CASE k % 3 WHEN 0 THEN concat(' Mens SZIE ', size, '.0 350ml') WHEN 1 THEN concat(' JP ', size) ELSE concat(' US ', size) END)"
    return ("lettered_article",
        {"article": "concat('AB', d, '-', CASE WHEN k % 4 = 0 THEN '77' ELSE upper(word) END)", "spec": spec},
        {"model": "concat('0', d, '.0')", "color": "CASE WHEN pos % 4 = 0 THEN '黑' ELSE upper(word) END", "size": "concat(CASE WHEN pos % 2 = 0 THEN 'US' ELSE '' END, size)"},
    )


@query(
    _match(
        "d AS model, CASE WHEN k % 4 = 0 THEN '黑' ELSE upper(word) END AS color, CASE WHEN k % 3 = 2 THEN 'US' ELSE '' END || size AS z",
        "d AS model, CASE WHEN pos % 4 = 0 THEN '黑' ELSE upper(word) END AS color, CASE WHEN pos % 2 = 0 THEN 'US' ELSE '' END || size AS z",
    )
)
def brand_lettered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_lettered_sides())


# --- a colour word that holds the supply's colour, sizes by SIZE, US and age ------


_AGES = "CASE {k} % 3 WHEN 0 THEN substr('SML', cast(size % 3 + 1 AS INTEGER), 1) WHEN 1 THEN concat(cast(size % 6 + 2 AS VARCHAR(9)), CASE WHEN size % 6 + 2 <= 5 THEN 'T' ELSE 'M' END) ELSE cast(size AS VARCHAR(9)) END"


def _colour_in_word_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = "concat('（红）', CASE k % 3 WHEN 0 THEN concat(' SIZE ', substr('SML', size % 3 + 1, 1)) WHEN 1 THEN concat(' Age ', size % 6 + 2) ELSE concat(' US ', size) END)"
    return ("colour_in_word", {"article": "concat('0', d, upper(word), '9')", "spec": spec}, {"model": "d", "color": "substr(upper(word), 2, 3)", "size": _AGES.format(k="pos")})


@query(_match(f"d AS model, upper(word) AS color, {_AGES.format(k='k')} AS z", f"d AS model, substr(upper(word), 2, 3) AS color, {_AGES.format(k='pos')} AS z", "contains(o.color, s.color)"))
def brand_colour_in_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_colour_in_word_sides())


# --- a suffix as colour, European sizes by two charts, lists of sizes ---------------

_TWO = {36: ["23"], 37: ["23.5", "24"], 38: ["24", "24.5"], 39: ["25", "25.5"], 40: ["25.5"], 41: ["26.5"], 42: ["27"], 43: ["28"], 44: ["28.5"], 45: ["29.5"]}


def _suffix_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = f"concat('黑宽', CASE WHEN k % 2 = 0 THEN concat(' JP ', {_half('size', 'div')}) ELSE concat(' EU ', size) END)"
    color = "CASE WHEN {k} % 5 = 0 THEN '{none}' ELSE upper(word) END"
    return ("suffix_article",
        {"article": f"concat('DX', d, '-', {color.format(k='k', none='007')})", "spec": spec},
        {"model": "concat('dx', d)", "color": color.format(k="pos", none="黑"), "size": f"concat({_half('size', 'div')}, CASE WHEN size % 2 = 0 THEN '.0' ELSE '' END)"},
    )


@query(
    f"""WITH {_BASE}, chart(eu, jp) AS (VALUES {", ".join(f"({k}, '{v}')" for k, vs in _TWO.items() for v in vs)}),
o AS (SELECT pos, 'DX' || d AS model, CASE WHEN k % 5 = 0 THEN '黑' ELSE upper(word) END AS color, CASE WHEN k % 2 = 0 THEN {_half("size", "//")} ELSE jp END AS z FROM offers LEFT JOIN chart ON k % 2 = 1 AND eu = size),
s AS (SELECT pos, 'DX' || d AS model, CASE WHEN pos % 5 = 0 THEN '黑' ELSE upper(word) END AS color, {_half("size", "//")} AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND o.color = s.color AND o.z = s.z GROUP BY o.pos"""
)
def brand_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_suffix_sides())


@query(
    f"""WITH {_BASE},
o AS (SELECT pos, 'DX' || d AS model, unnest(CASE k % 4 WHEN 0 THEN ['C' || (size % 5), 'D' || (size % 5)] WHEN 1 THEN ['N' || (size % 5)] WHEN 2 THEN ['C' || (size % 5)] ELSE ['plain' || (size % 5)] END) AS color, 'M' AS z FROM offers),
s AS (SELECT pos, 'DX' || d AS model, CASE pos % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'N' WHEN 2 THEN 'C' ELSE 'plain' END || (size % 5) AS color, 'M' AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s USING (model, color, z) GROUP BY o.pos"""
)
def brand_colour_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheet gives a Chinese word two codes, an English name one, and a code itself."""
    digits = spark.range(5).selectExpr("id", "array('零', '一', '二', '三', '四')[cast(id AS int)] AS han")
    sheet = digits.selectExpr("id AS pos", "concat('C', id) AS code", "concat('name ', id) AS english", "concat('色', han, ', x') AS chinese")
    sheet = sheet.unionByName(digits.selectExpr("id + 10 AS pos", "concat('D', id) AS code", "'' AS english", "concat('色 ', han, 'Logo') AS chinese"))
    sheet = sheet.unionByName(digits.selectExpr("id + 20 AS pos", "concat('N', id) AS code", "concat('Shade ', id) AS english", "'' AS chinese"))
    spec = "concat(CASE k % 4 WHEN 0 THEN concat('色', array('零', '一', '二', '三', '四')[cast(size % 5 AS int)]) WHEN 1 THEN concat('sHADE ', size % 5) WHEN 2 THEN concat('c', size % 5) ELSE concat('Plain', size % 5) END, ' SIZE M')"
    color = "concat(CASE pos % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'N' WHEN 2 THEN 'C' ELSE 'plain' END, size % 5)"
    return _found(spark, sf_dir, "suffix_article", {"article": "concat('DX', d, '-01')", "spec": spec}, {"model": "concat('DX', d)", "color": color, "size": "'M'"}, sheet)


# --- sizes alone -----------------------------------------------------------------

_EU = {17: "10.5", 18: "11", 21: "13", 25: "15.5", 26: "16", 27: "17", 28: "17.25", 30: "18.5", 33: "20.5", 35: "22", 36: "22.5", 37: "23", 38: "24", 39: "24.5", 40: "25.25", 42: "26.5", 44: "28", 45: "28.5", 46: "29", 47: "30", 48: "30.5", 49: "31"}


def _dotted_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = f"CASE k % 4 WHEN 0 THEN concat('黑色 JP ', {_half('size', 'div')}, ' x') WHEN 1 THEN concat('黑色 EU ', size, '.0') WHEN 2 THEN '黑色 XL' ELSE '3双装 L' END"
    size = f"CASE pos % 3 WHEN 0 THEN {_half('size', 'div')} WHEN 1 THEN 'LL' ELSE '27-29' END"
    return ("dotted_model", {"article": "concat('abcdef', lpad(d, 2, '0'), CASE WHEN k % 2 = 0 THEN '-1' ELSE '1' END)", "spec": spec}, {"model": "concat('ABCDEF', lpad(d, 2, '0'), '.1')", "color": "'x'", "size": size})


@query(
    f"""WITH {_BASE}, {_values("chart", _EU)},
o AS (SELECT pos, 'ABCDEF' || lpad(d, 2, '0') || '.1' AS model, CASE k % 4 WHEN 0 THEN {_half("size", "//")} WHEN 1 THEN jp WHEN 2 THEN 'LL' ELSE '27-29' END AS z FROM offers LEFT JOIN chart ON eu = size),
s AS (SELECT pos, 'ABCDEF' || lpad(d, 2, '0') || '.1' AS model, CASE pos % 3 WHEN 0 THEN {_half("size", "//")} WHEN 1 THEN 'LL' ELSE '27-29' END AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND o.z = s.z GROUP BY o.pos"""
)
def brand_dotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_dotted_sides())


_CANVAS = {34: "21", 35: "22", 36: "22.5", 37: "23.5", 38: "38", 39: "39", 40: "25.5", 41: "26", 42: "27", 43: "28", 44: "28.5", 45: "29.5", 46: "30", 48: "31.5", 49: "32", 50: "33"}


def _canvas_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    half = _half("size", "div")
    spec = f"CASE k % 5 WHEN 0 THEN '黑 size m' WHEN 1 THEN concat('JP ', {half}, ' (EU ', 38 + k div 5 % 2, ')') WHEN 2 THEN concat('EU ', size) WHEN 3 THEN '23 - 25 厘米' ELSE '黑' END"
    size = f"CASE pos % 4 WHEN 0 THEN 'm(23.0-25.0)' WHEN 1 THEN '23-25' WHEN 2 THEN 'ONE' ELSE concat(CASE WHEN pos div 4 % 2 = 0 THEN '5.5' ELSE '7' END, '(', {half}, 'cm)') END"
    return ("canvas_sizes", {"article": "concat('c', d)", "spec": spec}, {"model": "concat('C', d)", "color": "''", "size": size})


@query(
    f"""WITH {_BASE}, {_values("chart", _CANVAS)},
o AS (SELECT pos, 'C' || d AS model, CASE k % 5 WHEN 0 THEN 'M' WHEN 1 THEN CASE WHEN {_half("size", "//")} = '24.5' THEN CAST(38 + k // 5 % 2 AS VARCHAR) ELSE {_half("size", "//")} END WHEN 2 THEN jp WHEN 3 THEN '23-25' ELSE 'ONE' END AS z FROM offers LEFT JOIN chart ON eu = size),
s AS (SELECT pos, 'C' || d AS model, CASE pos % 4 WHEN 0 THEN 'M' WHEN 1 THEN '23-25' WHEN 2 THEN 'ONE' ELSE CASE WHEN {_half("size", "//")} <> '24.5' THEN {_half("size", "//")} WHEN pos // 4 % 2 = 0 THEN '38' ELSE '39' END END AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND o.z = s.z GROUP BY o.pos"""
)
def brand_canvas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_canvas_sides())


_MEN = {35: "21", 36: "22", 37: "23", 38: "23.5", 39: "24.5", 40: "25.5", 41: "26.5", 42: "27", 43: "28", 44: "28.5", 45: "29.5", 46: "30", 47: "31", 48: "33", 49: "35"}
_WOMEN = {35: "22", 36: "23", 37: "23.5", 38: "24.5", 39: "25.5", 40: "26.5", 41: "27.5", 42: "28", 43: "29"}
_CHILDREN = {19: "11.5", 22: "13.5", 23: "14.5", 24: "15", 29: "18", 30: "18.5", 31: "19.5", 34: "21", 35: "22", 36: "22.5", 37: "23.5", 38: "24.5", 39: "25.5"}


def _outdoor_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = f"CASE k % 6 WHEN 3 THEN concat('黑 UK ', size, '(US 1)') WHEN 4 THEN concat('黑 US ', size) WHEN 5 THEN {_half('size', 'div')} ELSE concat('黑 EU ', size, '(UK 3)') END"
    name = "CASE k % 6 WHEN 1 THEN '女鞋' WHEN 2 THEN '童鞋' WHEN 4 THEN '女鞋' WHEN 5 THEN '鞋' ELSE '男鞋' END"
    return ("outdoor_sizes", {"article": "concat('x-', d, '.')", "spec": spec, "product_name": name}, {"model": "d", "color": "''", "size": f"concat({_half('size', 'div')}, CASE WHEN size % 2 = 0 THEN '.0' ELSE '' END)"})


@query(
    f"""WITH {_BASE}, {_values("men", _MEN)}, {_values("women", _WOMEN)}, {_values("children", _CHILDREN)},
o AS (SELECT pos, d AS model, CASE k % 6 WHEN 0 THEN men.jp WHEN 1 THEN women.jp WHEN 2 THEN children.jp WHEN 3 THEN CASE WHEN size BETWEEN 2 AND 16 THEN CAST(size + 19 AS VARCHAR) END
    WHEN 4 THEN CASE WHEN size BETWEEN 5 AND 12 THEN CAST(size + 17 AS VARCHAR) END ELSE {_half("size", "//")} END AS z
  FROM offers LEFT JOIN men ON men.eu = size LEFT JOIN women ON women.eu = size LEFT JOIN children ON children.eu = size),
s AS (SELECT pos, d AS model, {_half("size", "//")} AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND o.z = s.z GROUP BY o.pos"""
)
def brand_outdoor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_outdoor_sides())


_BOTH = {21: "13", 25: "15", 26: "16", 27: "17", 30: "18.5", 33: "20.5", 35: "22", 37: "23", 38: "24", 39: "24.5", 42: "26.5", 44: "28", 45: "28.5", 46: "29", 47: "30", 48: "30.5", 49: "31"}


def _gendered_sides() -> tuple[str, dict[str, str], dict[str, str]]:
    spec = f"CASE k % 4 WHEN 0 THEN concat('EU 1 eu ', size) WHEN 1 THEN concat('JP 19 JP', {_half('size', 'div')}) WHEN 2 THEN concat('SIZE 1 SIZE ', size) ELSE 'S 或 xl' END"
    name = "CASE k % 3 WHEN 0 THEN '男女同款' WHEN 1 THEN '女款' ELSE '鞋' END"
    size = f"CASE WHEN pos % 2 = 0 THEN {_half('size', 'div')} WHEN pos % 3 = 0 THEN 'XL' ELSE concat(size, '.0') END"
    return ("gendered_sizes", {"article": "concat('G', d)", "spec": spec, "product_name": name}, {"model": "concat('g', d)", "color": "''", "size": size})


@query(
    f"""WITH {_BASE}, {_values("chart", _BOTH)},
o AS (SELECT pos, 'G' || d AS model, CASE k % 4 WHEN 0 THEN CASE size WHEN 36 THEN CASE WHEN k % 3 = 1 THEN '22.75' ELSE '22.5' END WHEN 40 THEN CASE WHEN k % 3 = 1 THEN '25.5' ELSE '25.25' END ELSE jp END
    WHEN 1 THEN {_half("size", "//")} WHEN 2 THEN CAST(size AS VARCHAR) ELSE 'XL' END AS z FROM offers LEFT JOIN chart ON eu = size),
s AS (SELECT pos, 'G' || d AS model, CASE WHEN pos % 2 = 0 THEN {_half("size", "//")} WHEN pos % 3 = 0 THEN 'XL' ELSE CAST(size AS VARCHAR) END AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND o.z = s.z GROUP BY o.pos"""
)
def brand_gendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, *_gendered_sides())


@query(
    f"""WITH {_BASE}, s AS (SELECT 'M' || d AS model, arg_min(pos, pos) AS pos, arg_min(discounted_price, pos) AS price, arg_min(quantity, pos) AS quantity FROM goods GROUP BY 1)
SELECT o.pos, CASE WHEN s.pos IS NULL THEN '没有model匹配到，下架' ELSE concat_ws(chr(10), CASE WHEN price >= round_even(o.cost / 20, 0) THEN 'tianmao价格>=预计收入(JPY),tianmao价格=' END, CASE WHEN quantity = 0 THEN '没有库存，下架' END) END AS status,
  price AS cost, s.quantity AS new_stock, CAST(NULL AS BIGINT) AS bid_price FROM offers o LEFT JOIN s ON model = CASE WHEN k % 9 = 0 THEN 'none' ELSE 'M' || d END"""
)
def brand_model_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The margin message ends in the price, whose text is a matter of the dialect and is cut here."""
    listing = offers(spark, sf_dir).selectExpr("pos", "sku_id", "CASE WHEN k % 9 = 0 THEN 'none' ELSE concat('m', d) END AS article", "'any' AS spec", "'' AS product_name", "cost", "cost / 20 AS expected_income", "lead_time", "my_bid")
    supply = goods(spark, sf_dir).selectExpr("pos", "concat('M', d) AS model", "'x' AS size", "'y' AS color", "msrp", "discounted_price", "quantity")
    got = R.reconcile_listing(listing, supply, profile("model_only"))
    return got.selectExpr("pos", "regexp_replace(status, '(?<==)[0-9.E]+', '') AS status", "CASE WHEN new_stock IS NOT NULL THEN cast(cost AS double) END AS cost", "new_stock", "bid_price")


# --- sizes within a billionth, colours out of the text ---------------------------------


def _off(n: str, div: str) -> str:
    """A half size with 1e-8 or 1e-7 more, or as it is, by `pos`."""
    return f"concat({_half(n, div)}, CASE WHEN {n} % 2 = 0 THEN '.0' ELSE '' END, CASE pos % 3 WHEN 0 THEN '0000001' WHEN 1 THEN '000001' ELSE '' END)"


@query(
    f"""WITH {_BASE}, o AS (SELECT pos, 'ABCDEF' || lpad(d, 2, '0') || '.1' AS model, CAST({_half("size", "//")} AS DOUBLE) AS z FROM offers),
s AS (SELECT pos, 'ABCDEF' || lpad(d, 2, '0') || '.1' AS model, CAST({_off("size", "//")} AS DOUBLE) AS z FROM goods)
SELECT o.pos, min(s.pos) AS supply_pos FROM o JOIN s ON o.model = s.model AND abs(o.z - s.z) <= greatest(1e-9::DOUBLE * greatest(o.z, s.z), 1e-9::DOUBLE) GROUP BY o.pos"""
)
def close_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir, "dotted_model", {"article": "concat('abcdef', lpad(d, 2, '0'), '-1')", "spec": f"concat('黑 JP ', {_half('size', 'div')})"}, {"model": "concat('ABCDEF', lpad(d, 2, '0'), '.1')", "color": "'x'", "size": _off("size", "div")})


@query(
    _match(
        f"d AS model, '红/' || upper(word) AS color, {_AGES.format(k='k')} AS z",
        f"d AS model, CASE pos % 4 WHEN 0 THEN '红' WHEN 1 THEN upper(word) WHEN 2 THEN '/' || substr(upper(word), 1, 2) ELSE '蓝' END AS color, {_AGES.format(k='pos')} AS z",
        "contains(o.color, s.color)",
    )
)
def brand_colour_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article of digits alone: the colour is read out of the text, by slash, by hyphen, in brackets and by script."""
    color = "CASE k % 4 WHEN 0 THEN concat('红/', upper(word)) WHEN 1 THEN concat('红-', upper(word)) WHEN 2 THEN concat('（红/', upper(word), '）') ELSE concat('红', upper(word)) END"
    spec = f"concat({color}, CASE k % 3 WHEN 0 THEN concat(' SIZE ', substr('SML', size % 3 + 1, 1)) WHEN 1 THEN concat(' Age ', size % 6 + 2) ELSE concat(' US ', size) END)"
    own = "CASE pos % 4 WHEN 0 THEN '红' WHEN 1 THEN upper(word) WHEN 2 THEN concat('/', substr(upper(word), 1, 2)) ELSE '蓝' END"
    return _found(spark, sf_dir, "colour_in_word", {"article": "concat('0', d)", "spec": spec}, {"model": "d", "color": own, "size": _AGES.format(k="pos")})


# --- the whole reconciliation by each profile ---------------------------------------

_reconciled("size_list", _size_list_sides)
_reconciled("lettered", _lettered_sides)
_reconciled("colour_in_word", _colour_in_word_sides)
_reconciled("suffix", _suffix_sides)
_reconciled("dotted", _dotted_sides)
_reconciled("canvas", _canvas_sides)
_reconciled("outdoor", _outdoor_sides)
_reconciled("gendered", _gendered_sides)
