"""Source order over several files, and the plans of the page operators."""

import pytest

from skumill import queries
from skumill.operators import extract as E
from skumill.operators import lookup as N
from skumill.sources import readers as R
from skumill.sources import sinks as O

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_pieces(spark):
    """Files in many pieces, which Spark packs into tasks by size."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rows_are_numbered_by_file_and_line(spark, tmp_path, small_pieces):
    want = []
    for name, n in (("a.txt", 3), ("b.txt", 4000), ("c.txt", 700)):  # the largest comes first in Spark's own order
        lines = [f"https://{name}/{k}" for k in range(n)]
        (tmp_path / name).write_text("\n".join(["# head", *lines]) + "\n")
        want += lines
    got = R.seed_list(spark, str(tmp_path / "*.txt")).orderBy("pos").collect()
    assert [r.seed_url for r in got] == want
    assert [r.pos for r in got] == [*range(1, 4), *range(5, 4005), *range(4006, 4706)]


def test_lead_rows_go_in_every_file(spark, tmp_path, small_pieces):
    for name, n in (("b.csv", 900), ("a.csv", 2)):
        (tmp_path / name).write_text("model,size,m,d,c,q,r\n" + "".join(f"{name}{k},{k},1,,x,1,\n" for k in range(n)))
    got = [r.model for r in R.supply_table(spark, str(tmp_path / "*.csv")).orderBy("pos").collect()]
    assert got == [f"a.csv{k}" for k in range(2)] + [f"b.csv{k}" for k in range(900)]
    for name, n in (("x.tsv", 2), ("y.tsv", 800)):
        (tmp_path / name).write_text("brand\tmodel\turls\n" + "".join(f"{name}\t{k}\tu\n" for k in range(n)))
    got = [r.value.split("\t")[:2] for r in R.headed_lines(spark, str(tmp_path / "*.tsv")).orderBy("pos").collect()]
    assert got == [["x.tsv", str(k)] for k in range(2)] + [["y.tsv", str(k)] for k in range(800)]


def test_the_last_run_of_a_log_counts(spark, tmp_path, small_pieces):
    path = str(tmp_path / "log")
    kind = "n int, url string, rows array<string>"
    big = [(k, f"u{k % 50}", [f"first {k}"]) for k in range(600)]
    O.append_log(spark.createDataFrame(big, kind).repartition(3), path, order="n")
    got = {r.url: r.rows for r in R.work_log(spark, path).collect()}
    assert got == {f"u{k}": [f"first {550 + k}"] for k in range(50)}
    O.append_log(spark.createDataFrame([(0, "u1", ["second"])], kind), path)
    O.append_log(spark.createDataFrame([(0, "u1", ["third"]), (0, "u2", [])], kind), path)
    got = {r.url: r.rows for r in R.work_log(spark, path).collect()}
    assert got["u1"] == ["third"] and got["u2"] == [] and got["u3"] == ["first 553"]


def test_large_dictionaries_are_searched_as_small_ones(spark):
    words = [(k, f"w{k}", f"v{k}") for k in range(300)] + [(5, "w", "short"), (2, None, "none")]
    d = spark.createDataFrame(words, "pos int, word string, value string")
    t = spark.createDataFrame([(f"x w{k} w{k // 2}y",) for k in range(0, 300, 7)] + [("nothing",), (None,), ("",)], "t string")
    want = sorted(map(tuple, N.first_contained(t, "t", "word", d, "c").collect()), key=repr)
    assert len({v for _, v in want}) > 5
    for part_words in (1000, 40):
        assert sorted(map(tuple, N.first_contained(t, "t", "word", d, "c", most_words=10, part_words=part_words).collect()), key=repr) == want
    every = d.where("pos = 299").unionByName(spark.createDataFrame([(400, "", "any")], "pos int, word string, value string"))
    assert {r.c for r in N.first_contained(t, "t", "word", every, "c", most_words=1).where("t is not null").collect()} == {"any"}


def test_a_dictionary_of_many_parts_is_joined_not_collected(spark, monkeypatch):
    words = [((k * 7919) % 503, f"w{'é' * (k % 4)}{k}", f"v{k}" if k % 5 else None) for k in range(700)] + [(9, "😀x", "face"), (2, None, "none"), (600, "w7", "later")]
    d = spark.createDataFrame(words, "pos int, word string, value string")
    texts = [f"a w{'é' * (k % 4)}{k} w{k // 2}y{'-' * (k % 50)}" for k in range(0, 700, 3)] + ["nothing", None, "", "b 😀x", "b 😀x"]
    t = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "id int, t string")
    held = lambda x: min(((p, w, v) for p, w, v in words if w is not None and w in x), default=(0, "", None))[2]
    want = [(k, None if x is None else held(x)) for k, x in enumerate(texts)]
    monkeypatch.setattr(N, "_in_automata", None)  # no part is collected and compiled
    got = N.first_contained(t, "t", "word", d, "c", most_words=10, part_words=20)
    assert sorted((r.id, r.c) for r in got.collect()) == want
    every = d.unionByName(spark.createDataFrame([(-1, "", "any")], "pos int, word string, value string"))
    assert {r.c for r in N.first_contained(t, "t", "word", every, "c", most_words=10, part_words=20).where("t is not null").collect()} == {"any"}


def test_pages_are_parsed_in_their_own_row(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rows, failed = E.variant_rows(queries.layer_pages(spark, SF), "house", "https://images.example/is/image/")
    products, without = E.product_pages(queries.grouped_pages(spark, SF), "https://shop.example", "house")
    for df in (rows, failed, products, without, E.variant_prices(queries.layer_pages(spark, SF))):
        assert "Exchange" not in plan(df) and "Join" not in plan(df)
    exchanges = [line for line in plan(queries.catalogue_rows(spark, SF)).splitlines() if "Exchange" in line]
    assert exchanges and not any("html" in line for line in exchanges)


def test_pages_of_a_small_part_file_are_dealt_over_all_tasks(spark):
    for name in ("page_images", "swatchless_pages", "store_stock", "page_urls"):
        assert queries.queries()[name](spark, SF).rdd.getNumPartitions() == 4, name


def test_a_composed_page_is_not_composed_anew_for_each_reading(spark):
    rows, _ = E.variant_rows(queries.layer_pages(spark, SF), "house", "https://images.example/is/image/")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("<html><h1> ") == 1


def test_own_prices_and_repeated_variants(spark):
    own = '{"linkedProduct":{"a":{"sku":"K1","price":{"displayRegularPrice":"¥ 100","displayPrice":"90"}},"b":{"sku":"K1","price":{"displayRegularPrice":"¥ 200","displayPrice":"200"}},"c":{"price":"7"}}}'
    v = '{"productInfo":{"sku":"K1","color":"red","size":"S"},"attributes":{"stockStatus":"in-stock"}}'
    data = '{"productInfo":{"productID":"P1","productName":"N"},"price":{"displayRegularPrice":"¥ 50"},"linkedProduct":[' + ",".join([v, v, v.replace("K1", "K2").replace("red", "blue")]) + "]}"
    html = f"<h1>t</h1><script>digitalData.product.push({data});var satelliteData = {own};</script>"
    pages = spark.createDataFrame([("https://h/prod1.html", html), ("https://h/prod2.html", "<h1></h1><title>bare</title>")], "url string, html string")
    assert [tuple(r) for r in E.variant_prices(pages).collect()] == [("https://h/prod1.html", "K1", "200", "")]
    rows, failed = E.variant_rows(pages, "house", "https://i/")
    assert sorted((r.url[-6], r.title, r.color, r.msrp, r.quantity) for r in rows.collect()) == [("1", "N", "blue", "50", "6"), ("1", "N", "red", "200", "6"), ("2", "bare", "", "", "")]
    assert failed.count() == 0
