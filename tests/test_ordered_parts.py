"""Windows cut along any sortable order, brand-wise charts, listings, nested JSON and tolerant joins."""

import datetime
import decimal
import json
import random

import pytest
from pyspark.sql import functions as F

from skumill.functions import price as M
from skumill.operators import dedupe as W
from skumill.operators import extract as E
from skumill.operators import manifest as J
from skumill.operators import reconcile as R
from skumill.plans.profiles import PROFILES, profile
from skumill.sources import readers
from skumill.sources import sinks as O
from skumill.streaming import incremental as I


def texts(df):
    return sorted(str(tuple(r)) for r in df.collect())


def ordered_rows():
    rng = random.Random(5)
    first, out = datetime.datetime(2024, 3, 30, 22), []
    for i in range(500):
        key = rng.choice([None, "a", "b"]) if i < 200 else "hot"
        out.append((key, f"{i:04d}"[::-1], decimal.Decimal(i) / 7, first + datetime.timedelta(minutes=i), i // 50, i, rng.choice(["x", "x", "x", "y", None]), rng.choice([None, i])))
    return out + [out[300]] * 3


@pytest.mark.parametrize("order", [["t"], ["d"], ["down", "day", "ts"], ["g"]])
def test_any_order_is_cut_alike(spark, order):
    df = spark.createDataFrame(ordered_rows(), "k string, t string, d decimal(12,4), ts timestamp, g int, i int, code string, v int")
    df = df.withColumn("day", F.to_date("ts")).withColumn("down", F.when(F.col("i") % 5 != 0, -F.col("i")))
    for f in (
        lambda n: W.with_runs(df, ["k"], order, F.col("code"), plain_rows=n),
        lambda n: W.carry_forward(df, ["k"], order, F.col("code"), F.col("v"), plain_rows=n),
        lambda n: W.failure_streaks(df, ["k"], order, F.col("code") == "x", plain_rows=n),
    ):
        assert W.in_parts(df, ["k"], order, 0)[1] == ["_part", "_cut"] and W.in_parts(df, ["k"], order, 10_000)[1] == []
        assert texts(f(0)) == texts(f(10_000))
    numbered = lambda n: sorted(r.batch_id for r in W.batch_ids(df, order, 7, plain_rows=n).collect())
    assert numbered(0) == numbered(10_000) == [i // 7 for i in range(503)]


def test_runs_of_a_text_order(spark):
    data = [(str(i), "a" if i % 10 < 5 else "b") for i in range(1, 31)]
    codes = [c for _, c in sorted(data)]
    df = spark.createDataFrame(data, "at string, code string").withColumn("k", F.lit(1))
    for rows in (0, 1000):
        assert W.with_runs(df, ["k"], ["at"], F.col("code"), plain_rows=rows).agg(F.max("run")).first()[0] == 1 + sum(a != b for a, b in zip(codes, codes[1:], strict=False))


def test_charts_of_the_own_brand_and_run(spark):
    sheet = spark.createDataFrame([("s", i, *r) for i, r in enumerate([("A", "one", "B1"), ("B", "two", "B2"), ("A", "three", "B1"), ("Y", "four", "B9"), ("Y", "four", "B2")])], "sheet string, pos int, Code string, Description string, brand string")
    there = spark.createDataFrame([("sizetoimg/B1/Y.jpg", "1" * 16), ("sizetoimg/B2/Y.jpg", "2" * 16), ("sizetoimg/B2/z/Y.jpg", "3" * 16), ("Y.jpg", "4" * 16)], "key string, hash string")
    out, charts = J.size_charts(sheet, there, F.col("brand"), "https://c", folder=J.CHARTS)
    got = {r.pos: (r.outcome, r.size_image) for r in out.collect()}
    assert out.count() == 5 and [got[k][0] for k in range(5)] == ["created", "created", "created", "created", "reused"]
    assert got[4][1] == "https://c/sizetoimg/B2/z/Y.jpg?v=" + "3" * 12
    first, again = got[0][1].split("?"), got[2][1].split("?")
    assert first[0] == again[0] and first[1] != again[1]  # one address, each run's own version
    assert {r.key: "three" in r.html for r in charts.collect()} == {"sizetoimg/B1/A.jpg": True, "sizetoimg/B2/B.jpg": False, "sizetoimg/B9/Y.jpg": False}
    everywhere, _ = J.size_charts(sheet, there, F.col("brand"), "https://c")
    assert everywhere.count() == 5 and everywhere.where("outcome = 'reused'").select("size_image").distinct().count() == 1


def test_newest_opens_one_file(spark, tmp_path):
    for name in ("e1", "e2", "e3"):
        (tmp_path / f"{name}.csv").write_text(name)
    got = readers.newest(spark, str(tmp_path / "e*.csv"))
    assert [tuple(r) for r in got.collect()] == [("e3",)] and len(got.inputFiles()) == 1
    assert sorted((r.name, r.size) for r in readers.file_listing(spark, str(tmp_path / "*.csv")).collect()) == [(f"e{k}.csv", 2) for k in (1, 2, 3)]


def test_prices_of_any_size(spark):
    df = spark.createDataFrame([(12345678.0, 1.5e12, 0.00001, 120.9), (None, -2.5e7, 0.0, float("nan"))], "a double, b double, c double, d double")
    got = [tuple(r) for r in df.select(*[M.price_text(F.col(c)) for c in "abcd"]).collect()]
    assert got == [("12345678", "1500000000000", "0", "120"), ("", "25000000", "0", "")]
    assert [r[0] for r in df.select(M.plain_text(F.col("a"))).collect()] == ["12345678.0", None]


def test_nested_objects_keep_their_order(spark):
    deep = {"sku": "end"}
    for k in range(900):
        deep = {"k": deep} if k % 2 else [deep]
    wide = "[" + ",".join(f'{{"n":{k},"t":"}}{{\\""}}' for k in range(200_000)) + "]"
    script = lambda t: f'<script type="application/json">{t}</script>'
    pages = spark.createDataFrame([("deep", script(json.dumps(deep))), ("wide", script('{"sku": "first"}') + script("{broken") + script(wide)), ("none", None)], "url string, html string")
    found = E.nested_objects(pages)
    assert found.where("url = 'deep'").count() == 451
    assert found.where("url = 'deep'").orderBy(F.desc("pos")).select(F.try_variant_get("object", "$.sku", "string")).first()[0] == "end"
    n = F.try_variant_get("object", "$.n", "int")
    rows = found.where("url = 'wide' and pos[0] = 2").select("pos", n.alias("n"))
    assert rows.count() == 200_000 and rows.where("pos[1] <> n").count() == 0
    assert found.where("url = 'wide' and pos[0] < 2").count() == 1


def test_sizes_within_a_billionth(spark):
    near = {"24": "24.00000001", "0.5": "0.5000000009", "2000000": "2000000.001", "LL": "LL", "26": "26.0000001", "1": "0.9999999995", "27": "L"}
    listing = spark.createDataFrame([(i, f"S{i}", "M1", f"JP {s}" if s != "LL" else "XL") for i, s in enumerate(near)], "pos int, sku_id string, article string, spec string").withColumn("product_name", F.lit(""))
    supply = spark.createDataFrame([(i, "M1.", s, "", 1.0, 1.0, 1) for i, s in enumerate(near.values())], "pos int, model string, size string, color string, msrp double, discounted_price double, quantity int")
    listing = listing.withColumn("article", F.lit("M1."))
    got = {r.pos: r.supply.pos for r in R.first_match(listing, supply, profile("dotted_model")).collect()}
    sizes = list(near)
    want = {}
    for i, a in enumerate(sizes):
        for j, b in enumerate(near.values()):
            x, y = (float(v) if v[0].isdigit() else None for v in (a, b))
            if (a == b) if x is None or y is None else abs(x - y) <= max(1e-9 * max(x, y), 1e-9):
                want.setdefault(i, j)
    assert got == want == {0: 0, 1: 1, 2: 2, 3: 3, 5: 5}
    plan = R.first_match(listing, supply, profile("dotted_model"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_contained_colours_of_one_popular_model(spark):
    colours = [f"c{k:03d}" for k in range(300)] + ["", "é日"]
    supply = spark.createDataFrame([(i, "7", "M", c, 1.0, None, 1) for i, c in enumerate(colours)], "pos int, model string, size string, color string, msrp double, discounted_price double, quantity int")
    words = ["xc007c100", "c299", "nothing", "é日x", "c0"]
    asks = spark.createDataFrame([(i, f"S{i}", "7", "M", w) for i, w in enumerate([*words, None])], "pos int, sku_id string, _model string, _size string, _want string")
    firsts = R._earliest(supply, profile("colour_in_word"))
    pairs = R._holding_colors(asks, firsts)
    got = sorted((r.pos, r.supply.pos) for r in pairs.collect())
    assert got == sorted((i, j) for i, w in enumerate([*words, None]) for j, c in enumerate(colours) if (c == "" if w is None else c in w))
    assert "Contains" not in pairs._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_plans_of_all_profiles_stay_small(spark):
    listing = spark.createDataFrame([(1, "S", "A-1", "黑 SIZE M", "鞋")], "pos int, sku_id string, article string, spec string, product_name string")
    supply = spark.createDataFrame([(1, "A", "M", "黑", 1.0, None, 1)], "pos int, model string, size string, color string, msrp double, discounted_price double, quantity int")
    for name in PROFILES:
        plan = R.first_match(listing, supply, profile(name))._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 50_000, (name, len(plan))


def test_a_batch_worked_off_twice_counts_once(spark, tmp_path):
    source, state, out = (f"file://{tmp_path}/{n}" for n in ("source", "state", "out"))
    log = spark.createDataFrame([("a", "failed", None), ("b", "done", None)], "url string, status string, error string")
    log.write.parquet(source)
    stream = lambda: spark.readStream.schema(log.schema).parquet(source)
    publish, broken = I.upsert_status(out), [True]

    def fails_once(batch, number):
        publish(batch, number)
        if broken.pop() if broken else False:
            raise RuntimeError("after the write, before the commit")

    with pytest.raises(Exception, match="after the write"):
        I.run_incremental(stream(), state, fails_once)
    assert spark.read.parquet(out).count() == 2
    log.where("url = 'a'").write.mode("append").parquet(source)
    I.run_incremental(stream(), state, fails_once)
    I.run_incremental(stream(), state, fails_once)
    now = {r.url: r.attempts for r in I.latest_status(spark.read.parquet(out)).collect()}
    assert now == {"a": 2, "b": 1}
    I.run_incremental(stream(), state + "2", I.upsert_status(out))  # a stream of its own
    assert {r.url: r.attempts for r in I.latest_status(spark.read.parquet(out)).collect()} == {"a": 4, "b": 2}


def test_current_runs_read_only_their_folders(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    for stamp in ("1", "2", "3"):
        for brand in ("p", "q/ r"):
            O.write_run(spark.createDataFrame([(brand, stamp)], "b string, t string"), path, stamp, brand)
    got = O.current_runs(spark, path)
    assert sorted(map(tuple, got.select("b", "t").collect())) == [("p", "3"), ("q/ r", "3")]
    assert len([f for f in got.inputFiles()]) >= 2 and "PartitionFilters: [" in got._jdf.queryExecution().executedPlan().toString()
    assert O.drop_old_runs(spark, path, keep=2) == 2 and O.drop_old_runs(spark, path) == 2 and O.drop_old_runs(spark, path) == 0
    assert O.current_runs(spark, path).count() == 2


def test_state_with_timers_asks_for_its_store(spark):
    log = spark.createDataFrame([("a", datetime.datetime(2024, 1, 1), 1, True)], "host string, ts timestamp, id long, failed boolean")
    with pytest.raises(ValueError, match="RocksDB"):
        I.ordered_streak_stream(log)


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    kept = O.fresh_path(spark, "kept")
    with O.scratch(spark):
        inner = O.written(spark.range(5), "inner")
        inner.write.parquet(kept)
        files = inner.inputFiles()
        assert inner.count() == 5
    assert spark.read.parquet(kept).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(files[0].rsplit("/", 1)[0]).count()
