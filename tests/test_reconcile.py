"""Profiles, statuses and order stability of the reconciliation."""

from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from skumill import queries_brands as B
from skumill import schemas as S
from skumill.operators import reconcile as R
from skumill.plans.profiles import PROFILES, profile

SUPPLY = "pos long, model string, size string, msrp double, discounted_price double, color string, quantity int"
LISTING = "pos long, sku_id string, article string, spec string, product_name string, cost string, lead_time int, my_bid double, expected_income string"


def supply(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SUPPLY)


def listing(spark, rows):
    full = [(i, f"S{i}", *r, *([None] * (4 - len(r)))) for i, r in enumerate(rows)]
    return spark.createDataFrame([(i, s, a, p, n, c, 3, 99.0, "5,000") for i, s, a, p, n, c in full], LISTING)


def taken(spark, name, offers, stock, sheet=None):
    """The supply position that each listing takes, None without one."""
    df = listing(spark, offers)
    got = {r.pos: r.supply.pos for r in R.first_match(df, supply(spark, stock), profile(name), sheet).collect()}
    return [got.get(i) for i in range(len(offers))]


def item(model, size=None, color=None, quantity=1):
    return (model, size, 12000.0, None, color, quantity)


def test_size_list(spark):
    stock = [item("a1", "S"), item("A1", "24.0"), item("a1", "3XL"), item("a1", "XXL"), item("b", "M")]
    offers = [("A1", "白色 SIZE S/M"), ("a1", "JP 24"), ("a1", "SZIE XXXL"), ("a1", "灰 EU 2XL"), ("A1", None), ("b", "M(12/14)"), ("b", "Mens M"), ("c", "M")]
    assert taken(spark, "size_list", offers, stock) == [0, 1, 2, 3, None, 4, 4, None]


def test_lettered_article_matches_models_as_digits(spark):
    stock = [item("1101.0", "M", "BK"), item("1101", "L", "BK"), item("01101", "M", None), item("1102", None, "RD"), item("1101", "US9", "NV")]
    offers = [("1101-BK", "黑色 SIZE M"), ("1101-BK", "SIZE L"), ("1101", "SIZE M"), ("1102-RD", "350ml"), ("NODIGITS", "SIZE M"), ("1101-NV", "US 9")]
    # without a sheet the first colour word stands; a wordless spec leaves its own text as colour
    assert taken(spark, "lettered_article", offers, stock) == [0, 1, None, 3, None, 4]
    sheet = spark.createDataFrame([(0, "BK", "Black", "黑色, 深黑"), (1, "NV", "Navy", "海军蓝")], "pos int, code string, english string, chinese string")
    assert taken(spark, "lettered_article", [("1101", "黑色 SIZE M"), ("1101", "Navy US 9"), ("1101", "bk JP L")], stock, sheet) == [0, 4, 1]


def test_blank_listing_size_does_not_match_any_colour(spark):
    stock = [item("7", "", None), item("7", "", "RD")]
    assert taken(spark, "lettered_article", [("7-BK", "350ml"), ("7-RD", "350ml")], stock) == [None, 1]


def test_colour_in_word(spark):
    stock = [item("60421", "3T", "BLK"), item("60421", "12M", "BLK"), item("60421", "M", "WHI"), item("60421", "S", "")]
    offers = [("60421-BLK", "Age 3"), ("60421BLK", "Age 12"), ("60421", "WHI M"), ("60421-GRN", "SIZE S"), ("60421-GRN", "SIZE M"), ("x", "M")]
    assert taken(spark, "colour_in_word", offers, stock) == [0, 1, 2, 3, None, None]


def test_suffix_article(spark):
    stock = [item("AB-1", "24.5", "BK00"), item("AB-1", "25.0", "BK00"), item("AB-1", "M", None)]
    offers = [("AB-1-BK00", "EU 38.5"), ("AB-1-BK00", "JP 25"), ("AB-1-123", "SIZE M"), ("AB-1-123", "黑 SIZE M")]
    got = taken(spark, "suffix_article", offers, stock)
    assert got[:2] == [0, 1] and got[2] == 2 and got[3] is None


def test_dotted_model(spark):
    stock = [item("1183A872.001", "27.5"), item("3013A801.001", "25-27"), item("1183A872.001", "LL")]
    offers = [("1183A872-001", "黑色 EU 43.5"), ("1183a872001", "JP 27.5"), ("3013A801-001", "3双装 M"), ("1183A872-001", "XL"), ("1183A872-001", "none")]
    assert taken(spark, "dotted_model", offers, stock) == [0, 0, 1, 2, None]


def test_canvas_sizes(spark):
    stock = [item("M9", "5.5(24.5cm)"), item("M9", "6(24.5cm)"), item("M9", "10.5(29.0cm)"), item("M9", "S(23.0-25.0)"), item("M9", "27-29"), item("M9", "ONE"), item("M9", None)]
    offers = [("M9", "JP 24.5 (EU 38)"), ("m9", "EU 39"), ("M9", "JP 29"), ("M9", "SIZE s"), ("M9", "SIZE 27-29"), ("M9", None), ("M9", "EU 44.5"), ("M9", "EU 99")]
    assert taken(spark, "canvas_sizes", offers, stock) == [0, 1, 2, 3, 4, 5, 2, None]


def test_outdoor_sizes(spark):
    stock = [item("1018", "27.5"), item("1018", "22.5"), item("1018", "M")]
    offers = [("x-1018.", "黑 EU 42.5(US 9)", "男鞋"), ("1018", "UK 3", "童鞋"), ("1018", "27.5", "鞋"), ("1018", "27.5", "童鞋"), ("NODIGITS", "EU 42.5", "男鞋"), ("1018", None, None)]
    assert taken(spark, "outdoor_sizes", offers, stock) == [0, 1, 0, None, None, None]


def test_gendered_sizes(spark):
    stock = [item("G1", "25.5"), item("G1", "25.25"), item("G1", "110"), item("G1", "XL"), item("G1", "ONE SIZE"), item("G1", "24.5")]
    offers = [("G1", "EU 40", "女款"), ("G1", "EU 40", "男女同款"), ("G1", "SIZE 100 SIZE 110"), ("G1", "M 或 xl"), ("G1", None), ("G1", "JP 22 JP 24.5"), ("G1", "EU 12")]
    assert taken(spark, "gendered_sizes", offers, stock) == [0, 1, 2, 3, 4, 5, None]


def test_model_only_judges_the_margin(spark):
    stock = supply(spark, [("C1", None, 9.0, 5000.0, None, 0), ("C2", None, 9.0, 10.0, None, 5)])
    offers = listing(spark, [("c1", "x"), ("C2", "y"), ("C3", "z")])
    got = R.reconcile_listing(offers, stock, profile("model_only")).orderBy("pos").collect()
    assert [r.status for r in got] == [S.MARGIN + "5000.0\n" + S.NO_STOCK, "", S.NO_MODEL]
    assert [r.cost for r in got] == ["5000.0", "10.0", None] and all(r.bid_price is None for r in got)


def test_statuses_costs_and_bids(spark):
    stock = supply(spark, [("A", "1", 12000.4, None, "x", 4), ("A", "2", 9000.0, 8000.0, "x", 0), ("A", "3", 100.0, float("nan"), "x", 0), ("A", "4", 100.0, 50.0, "x", 2), ("B", "1", 5.0, None, "x", 1), ("C", "1", 5.0, None, "x", 0)])
    offers = listing(spark, [("a", "x SIZE 1", None, None), ("A", "x SIZE 1", None, "12,000"), ("A", "x SIZE 1", None, "11 999"), ("A", "x SIZE 2", None, "-"), ("A", "y SIZE 1"), ("Z", "x SIZE 1"), (None, None)])
    got = R.reconcile_listing(offers, stock, profile("plain_spec")).orderBy("pos").collect()
    assert [r.status for r in got] == [S.COST_CHANGED, "", S.COST_CHANGED, f"{S.COST_CHANGED}\n{S.NO_STOCK}", S.NO_SPEC, S.NO_MODEL, S.NO_MODEL]
    assert [r.old_cost for r in got] == [None, None, 11999, None, None, None, None]
    assert [r.cost for r in got][:4] == ["12000.0", "12000.0", "12000.0", "9000.0"]
    # an unchanged cost is priced too
    assert [r.bid_price for r in got] == [16800, 16800, 16800, 13100, None, None, None]
    assert (got[0].new_lead_time, got[0].new_bid, got[0].new_stock, got[4].new_stock) == (3, 99.0, 4, None)
    sup = R.reconcile_supply(offers, stock, profile("plain_spec")).orderBy("pos").collect()
    assert [r.status for r in sup] == [S.MATCHED, S.MATCHED, S.NOTHING, S.PUT_UP_SPEC, S.PUT_UP, S.NOTHING]
    assert [r.sku_id for r in sup] == ["S2", "S3", None, None, None, None]
    assert sup[1].bid_price == 12000 and sup[2].bid_price == 2800


def test_discounted_price_is_compared_where_the_profile_says_so(spark):
    stock = supply(spark, [("11111111.001", "25", 9000.0, 8000.0, None, 4)])
    got = R.reconcile_listing(listing(spark, [("11111111-001", "JP 25", None, "8000"), ("11111111-001", "JP 25", None, "9000")]), stock, profile("dotted_model")).orderBy("pos").collect()
    assert [(r.status, r.cost, r.old_cost) for r in got] == [("", "8000.0", None), (S.COST_CHANGED, "9000.0", 9000)]


def test_order_of_the_input_does_not_matter(spark):
    stock = supply(spark, [item("A", str(k % 5), "x") for k in range(60)])
    offers = listing(spark, [("A", f"x SIZE {k % 7}") for k in range(80)])
    for name in ("plain_spec", "size_list"):
        want = sorted((r.pos, r.supply.pos) for r in R.first_match(offers, stock, profile(name)).collect())
        for seed in (1, 2):
            a, b = offers.repartition(7, F.xxhash64("pos", F.lit(seed))), stock.orderBy(F.xxhash64("pos", F.lit(seed)))
            assert sorted((r.pos, r.supply.pos) for r in R.first_match(a, b, profile(name)).collect()) == want
        assert want and all(s < 5 for _, s in want)


def test_empty_tables_and_unknown_profiles(spark):
    none_l, none_s = listing(spark, []), supply(spark, [])
    for p in PROFILES.values():
        assert R.reconcile_listing(none_l, none_s, p).count() == 0 and R.reconcile_supply(none_l, none_s, p).count() == 0
    with pytest.raises(KeyError):
        profile("nothing")


def test_tables_have_the_declared_widths():
    assert len(S.SUPPLY_POSITIONS) == 10 and len(S.LISTING_POSITIONS) == 42 and len(S.CATALOGUE_COLUMNS) == 19 and len(S.VARIANT_COLUMNS) == 12
    assert len(S.SUPPLY.fields) == 7 and len(S.LISTING.fields) == 39


def test_texts_that_listings_share_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(spec):
        read.add(1)
        return spec

    def wants(df, sheet):
        return used.wants(df.withColumn("spec", counted("spec")), sheet)

    stock = supply(spark, [item("7", "M", "RED"), item("7", "", ""), item("8", "M", "RED")])
    offers = listing(spark, [("7RED", "SIZE M"), ("7", None), (None, None), ("9", "SIZE M")] * 100)
    for name in ("colour_in_word", "plain_spec", "dotted_model"):
        used = profile(name)
        once = replace(used, wants=wants)
        want = {r.pos: r.supply.pos for r in R.first_match(offers, stock, used).collect()}
        before = read.value
        assert {r.pos: r.supply.pos for r in R.first_match(offers, stock, once).collect()} == want
        assert read.value - before <= 8, name  # four texts, not four hundred listings
        rows = {r.pos: r.status for r in R.reconcile_listing(offers, stock, used).collect()}
        assert len(rows) == 400 and all(rows[i] == rows[i % 4] for i in rows)
    assert rows[2] == S.NO_MODEL


def test_models_of_repeated_rows_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    stock = supply(spark, [item("7", "M", "RED"), item("7", "", ""), item("8", "M", "RED"), item("7", "M", "RED", 0)] * 50)
    offers = listing(spark, [("7RED", "SIZE M"), ("7", None), (None, None), ("9", "SIZE M")] * 100)
    for name in ("colour_in_word", "lettered_article", "plain_spec", "dotted_model"):
        used = profile(name)
        once = replace(used, listing_model=lambda c, p=used: p.listing_model(counted(c)), supply_model=lambda c, p=used: p.supply_model(counted(c)))
        R.first_match(offers, stock, once).collect()
        assert read.value <= 20, name  # four texts and three written supply rows, not 600
        R._models(offers, "article", once.listing_model).collect()
        assert read.value <= 30, name
        read.value = 0


def test_the_last_listing_of_a_supply_row_over_all_its_texts(spark):
    stock = supply(spark, [item("7", "M", "RED"), item("7", "S", "RED", 0), item("8", "M", "RED"), item("9", "M", "BLK", 0)])
    texts = [("7RED", "SIZE M"), ("7RED", "M"), ("07RED", "SIZE M 均码"), ("7RED", "SIZE S"), ("8BLK", "SIZE M"), (None, None)]
    offers = listing(spark, [texts[(k * 7) % 6] for k in range(90)])
    offers = offers.withColumn("sku_id", F.when(F.col("pos") != 87, F.col("sku_id"))).repartition(5)
    for name in ("colour_in_word", "lettered_article", "plain_spec", "dotted_model", "size_list"):
        used = profile(name)
        want = R.reconcile_supply(offers, stock, used, matches=R.first_match(offers, stock, used)).orderBy("pos").collect()
        plan = R.reconcile_supply(offers, stock, used)
        assert plan.orderBy("pos").collect() == want
        # listings are grouped by their texts, never joined with what the texts found
        joins = [line for line in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
        assert joins and not any("_text" in line for line in joins), name
    assert [r.sku_id for r in R.reconcile_supply(offers, stock, profile("colour_in_word")).orderBy("pos").collect()][2:] == [None, None]


def test_repeated_line_items_count_by_their_first_row(spark, tmp_path):
    part = "(VALUES (1, 'Brand#12', 'red x', 3, 9.5), (2, 'Brand#34', 'tan y', 4, 8.5)) t(p_partkey, p_brand, p_name, p_size, p_retailprice)"
    rows = "(1, 1, 2, 1, 1, 5.5), (1, 1, 1, 9, 9, 7.5), (1, 1, 1, 9, 9, 7.25), (1, 1, NULL, 0, 0, 0.5), (1, 2, 2, NULL, 1, 1.5), (1, 2, 2, 5, 8, 3.5), (1, 2, 2, 5, 8, NULL), (2, 1, NULL, 1, 1, 1.5), (2, 2, 1, NULL, NULL, NULL)"
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * REPLACE (CAST(p_retailprice AS DOUBLE) AS p_retailprice) FROM {part}) TO '{tmp_path}/part.parquet'")
    con.sql(f"""COPY (SELECT * REPLACE (CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice), 0.1 AS l_discount, 0.2 AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, DATE '2024-01-01' AS l_shipdate
      FROM (VALUES {rows}) t(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) TO '{tmp_path}/lineitem.parquet'""")
    for t in ("part", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    want = con.sql(f"WITH {B._BASE} SELECT pos, k, cost FROM offers ORDER BY pos").fetchall()
    assert [tuple(r) for r in B.offers(spark, str(tmp_path)).select("pos", "k", "cost").orderBy("pos").collect()] == want
    assert want == [(101, 1, 7.25), (102, 2, 3.5), (202, 1, None)]
    # a match needs no price: neither a sort of whole rows nor the columns of the order
    plan = B.brand_colour_in_word(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "min(struct" not in plan
