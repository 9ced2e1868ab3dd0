"""The registered queries over the given tables, each with its DuckDB equivalent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import html as H
from .functions import price as M
from .functions import sizes as Z
from .functions import text as X
from .functions import urls as U
from .operators import dedupe as W
from .operators import extract as E
from .operators import lookup as N
from .operators import manifest as J
from .operators import metrics as A
from .operators import reconcile as R
from .operators import stores as K
from .operators import titles as Ti
from .operators.bind import bound
from .plans.profiles import profile
from .registry import Query, registered, registered_sql
from .registry import query as _query
from .registry import table as _table
from .sources import sinks as O
from .streaming import incremental as I

# --- supply and listing tables derived from part and lineitem -----------------

_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    key, msrp = F.col("p_partkey"), F.col("p_retailprice") * F.col("p_size")
    return p.select(
        key.alias("pos"),
        F.when(key % 13 == 0, F.concat("p_brand", F.lit("-X"))).otherwise(F.col("p_brand")).alias("model"),
        F.col("p_size").cast("string").alias("size"),
        msrp.alias("msrp"),
        F.when(key % 3 != 0, msrp * F.lit(0.9)).alias("discounted_price"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
        (key % 7).cast("int").alias("quantity"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.first_rows(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    rows = lines.join(p, F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("l_partkey")
    pos = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return rows.select(
        pos.alias("pos"),
        F.concat(F.lit("S"), pos.cast("string")).alias("sku_id"),
        F.when(key % 11 == 0, "NOMODEL").otherwise(F.lower("p_brand")).alias("article"),
        F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(" SIZE "), F.when(key % 5 == 0, "X").otherwise(F.col("p_size").cast("string"))).alias("spec"),
        F.col("l_extendedprice").alias("cost"),
        (F.col("l_linenumber") + 2).alias("lead_time"),
        F.round(F.col("l_extendedprice") * 2, 0).alias("my_bid"),
        F.col("l_quantity").alias("l_quantity"),
        key.alias("l_partkey"),
    )


_SUPPLY = """supply AS (
  SELECT p_partkey AS pos, CASE WHEN p_partkey % 13 = 0 THEN p_brand || '-X' ELSE p_brand END AS model, CAST(p_size AS VARCHAR) AS size, p_retailprice * p_size AS msrp,
    CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice * p_size * 0.9::DOUBLE END AS discounted_price, split_part(p_name, ' ', 1) AS color, CAST(p_partkey % 7 AS INTEGER) AS quantity FROM part)"""
_LISTING = f"""lines AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1),
listing AS (
  SELECT l_orderkey * 100 + l_linenumber AS pos, 'S' || CAST(l_orderkey * 100 + l_linenumber AS VARCHAR) AS sku_id, CASE WHEN l_partkey % 11 = 0 THEN 'NOMODEL' ELSE lower(p_brand) END AS article,
    split_part(p_name, ' ', 1) AS color, CASE WHEN l_partkey % 5 = 0 THEN 'X' ELSE CAST(p_size AS VARCHAR) END AS size, l_extendedprice AS cost, l_linenumber + 2 AS lead_time,
    round(l_extendedprice * 2, 0) AS my_bid, l_partkey, l_quantity, p_size FROM lines JOIN part ON l_partkey = p_partkey)"""
_MATCH = """hits AS (
  SELECT l.pos, any_value(l.sku_id) AS sku_id, min(s.pos) AS spos FROM listing l JOIN supply s ON upper(l.article) = upper(s.model) AND l.color = s.color AND l.size = s.size GROUP BY l.pos)"""
_BID = "CAST(ceil((CASE WHEN {c} < 11500 THEN (1.15::DOUBLE * {c} + 2600) / 0.99::DOUBLE WHEN {c} <= 78500 THEN (1.15::DOUBLE * {c} + 1900) / 0.94::DOUBLE ELSE (1.15::DOUBLE * {c} + 5930) / 0.99::DOUBLE END) / 100) AS BIGINT) * 100"


@_query(f"WITH {_SUPPLY}, {_LISTING}, {_MATCH} SELECT pos, spos AS supply_pos FROM hits")
def reconcile_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.first_match(listing(spark, sf_dir), supply(spark, sf_dir), profile("plain_spec"))
    return got.select("pos", F.col("supply.pos").alias("supply_pos"))


@_query(
    f"""WITH {_SUPPLY}, {_LISTING}, {_MATCH},
full_rows AS (
  SELECT l.*, s.pos AS spos, s.quantity, round_even(s.msrp, 0) AS m, round_even(l.cost, 0) AS old,
    EXISTS (SELECT 1 FROM supply x WHERE upper(x.model) = upper(l.article)) AS known
  FROM listing l LEFT JOIN hits h ON l.pos = h.pos LEFT JOIN supply s ON h.spos = s.pos)
SELECT pos, CASE WHEN NOT known THEN '没有model匹配到，下架' WHEN spos IS NULL THEN '没有匹配到天猫的规格(颜色尺码)，下架'
  ELSE concat_ws(chr(10), CASE WHEN m <> old THEN '天猫价格和采购成本(JPY)不一致，已更新O列' END, CASE WHEN quantity = 0 THEN '没有库存，下架' END) END AS status,
  CASE WHEN spos IS NOT NULL THEN CAST(lead_time AS BIGINT) END AS new_lead_time, CASE WHEN spos IS NOT NULL THEN my_bid END AS new_bid, CASE WHEN spos IS NOT NULL THEN quantity END AS new_stock,
  CASE WHEN spos IS NOT NULL THEN m ELSE cost END AS cost, CASE WHEN spos IS NOT NULL AND m <> old THEN CAST(old AS BIGINT) END AS old_cost,
  CASE WHEN spos IS NOT NULL THEN {_BID.format(c="m")} END AS bid_price
FROM full_rows"""
)
def reconcile_listing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.reconcile_listing(listing(spark, sf_dir), supply(spark, sf_dir), profile("plain_spec"))
    return got.select("pos", "status", F.col("new_lead_time").cast("bigint"), "new_bid", "new_stock", F.col("cost").cast("double"), "old_cost", "bid_price")


@_query(
    f"""WITH {_SUPPLY}, {_LISTING}, {_MATCH}, taken AS (SELECT spos, arg_max(sku_id, pos) AS sku_id FROM hits GROUP BY spos)
SELECT s.pos, CASE WHEN t.spos IS NOT NULL THEN '匹配到' WHEN quantity <= 0 THEN '无需处理' WHEN EXISTS (SELECT 1 FROM listing l WHERE upper(l.article) = upper(s.model)) THEN '该货号没有规格匹配到，得物上架' ELSE '上架' END AS status,
  {_BID.format(c="coalesce(discounted_price, msrp)")} AS bid_price, t.sku_id FROM supply s LEFT JOIN taken t ON s.pos = t.spos"""
)
def reconcile_supply_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reconcile_supply(listing(spark, sf_dir), supply(spark, sf_dir), profile("plain_spec")).select("pos", "status", "bid_price", "sku_id")


@_query(f"WITH {_SUPPLY}, {_LISTING}, {_MATCH} SELECT spos AS supply_pos, arg_max(sku_id, pos) AS sku_id, count(*) AS n FROM hits GROUP BY spos")
def supply_last_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.first_match(listing(spark, sf_dir), supply(spark, sf_dir), profile("plain_spec"))
    return got.groupBy(F.col("supply.pos").alias("supply_pos")).agg(F.max_by("sku_id", "pos").alias("sku_id"), F.count("*").alias("n"))


@_query(
    f"""WITH {_SUPPLY}, {_LISTING}
SELECT l.pos, min(s.pos) AS supply_pos FROM listing l JOIN supply s ON upper(l.article) = upper(s.model) AND list_contains(string_split(CAST(p_size AS VARCHAR) || ',' || CAST(p_size + 1 AS VARCHAR), ','), s.size) GROUP BY l.pos"""
)
def size_list_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    rows = listing(spark, sf_dir).join(p, "l_partkey").withColumn("spec", F.concat(F.lit("黑色 SIZE "), F.col("p_size").cast("string"), F.lit("/"), (F.col("p_size") + 1).cast("string")))
    return R.first_match(rows, supply(spark, sf_dir), profile("size_list")).select("pos", F.col("supply.pos").alias("supply_pos"))


@_query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(p_size - l_quantity) <= greatest(1e-9 * greatest(abs(p_size), abs(l_quantity)), 1e-9) AS same FROM lineitem JOIN part ON l_partkey = p_partkey"
)
def tolerant_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", Z.same_size(F.col("p_size").cast("string"), F.col("l_quantity").cast("string")).alias("same"))


@_query(
    f"""WITH {_SUPPLY}, {_LISTING},
l AS (SELECT pos, article, CASE WHEN l_partkey % 4 = 0 THEN '' ELSE color END AS c, CASE WHEN l_partkey % 6 = 0 THEN '' ELSE size END AS z FROM listing),
s AS (SELECT pos, model, CASE WHEN pos % 5 = 0 THEN '' ELSE color END AS c, CASE WHEN pos % 8 = 0 THEN '' ELSE size END AS z FROM supply)
SELECT l.pos, min(s.pos) AS supply_pos FROM l JOIN s ON upper(l.article) = upper(s.model)
  AND ((l.c = s.c AND l.z = s.z) OR (l.c = '' AND l.z = s.z AND s.c = '') OR (l.c = s.c AND l.z = '' AND s.z = '')) GROUP BY l.pos"""
)
def three_way_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    color, size = F.regexp_extract("spec", "^(.*) SIZE ", 1), F.regexp_extract("spec", " SIZE (.*)$", 1)
    asked = listing(spark, sf_dir).withColumn("spec", F.concat(F.when(F.col("l_partkey") % 4 == 0, "").otherwise(color), F.lit(" SIZE "), F.when(F.col("l_partkey") % 6 == 0, "").otherwise(size)))
    s = supply(spark, sf_dir).withColumn("color", F.when(F.col("pos") % 5 == 0, "").otherwise(F.col("color"))).withColumn("size", F.when(F.col("pos") % 8 == 0, "").otherwise(F.col("size")))
    return R.first_match(asked, s, profile("plain_spec")).select("pos", F.col("supply.pos").alias("supply_pos"))


@_query(f"SELECT l_orderkey, l_linenumber, l_extendedprice, {_BID.format(c='l_extendedprice')} AS bid_price FROM lineitem")
def bid_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", M.bid_price(F.col("l_extendedprice")).alias("bid_price"))


@_query("SELECT p_partkey, CAST(CAST(round_even(p_retailprice * 1.1::DOUBLE, 0) AS BIGINT) AS VARCHAR) AS with_tax, '¥ ' || format('{:,}', CAST(floor(p_retailprice) AS BIGINT)) AS shown FROM part")
def tax_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return _table(spark, sf_dir, "part").select("p_partkey", M.with_tax(price).alias("with_tax"), M.yen(price).alias("shown"))


@_query(
    """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 9 = 0 THEN '-' WHEN l_partkey % 9 = 1 THEN NULL ELSE format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) END AS cost, round_even(p_retailprice * p_size, 0) AS m FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT *, TRY_CAST(replace(replace(cost, ' ', ''), ',', '') AS DOUBLE) AS old FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, old, m AS new_cost, CASE WHEN old IS NULL THEN 'set' WHEN old <> m THEN 'changed' ELSE 'same' END AS outcome FROM n"""
)
def cost_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    text = F.when(F.col("l_partkey") % 9 == 0, "-").when(F.col("l_partkey") % 9 != 1, F.format_number(F.floor("l_extendedprice"), 0))
    old, new = M.cost_number(text), F.bround(F.col("p_retailprice") * F.col("p_size"), 0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", old.alias("old"), new.alias("new_cost"), F.when(old.isNull(), "set").when(old != new, "changed").otherwise("same").alias("outcome"))


# --- deduplication, runs, state ----------------------------------------------


@_query("SELECT user_id, event_type, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.first_rows(_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"])


@_query(
    "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE text END AS k FROM documents) SELECT doc_id FROM d WHERE k = '' UNION ALL SELECT min(doc_id) FROM d WHERE k <> '' GROUP BY k"
)
def dedupe_keep_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("text")).alias("k"))
    return W.first_rows_keep_blank(d, "k", ["doc_id"]).select("doc_id")


@_query("SELECT count(*) AS rows, count(DISTINCT event_type || '|' || CAST(user_id AS VARCHAR)) AS kept, count(*) - count(DISTINCT event_type || '|' || CAST(user_id AS VARCHAR)) AS removed FROM events")
def dedupe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.dedupe_report(_table(spark, sf_dir, "events").withColumn("k", F.concat_ws("|", "event_type", F.col("user_id").cast("string"))), "k")


_RUNS = "runs AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) OR lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS chg FROM events))"


@_query(f"WITH {_RUNS} SELECT event_id, user_id, first_value(value) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS carried FROM runs")
def carry_forward_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.carry_forward(_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type"), F.col("value")).select("event_id", "user_id", "carried")


@_query(
    """WITH b AS (SELECT *, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS bad FROM events),
k AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block FROM b)
SELECT event_id, CAST(CASE WHEN bad = 1 THEN sum(bad) OVER (PARTITION BY user_id, block ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT) AS streak FROM k"""
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.failure_streaks(_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "click").select("event_id", "streak")


@_query("SELECT doc_id, source, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 60) AS BIGINT) AS batch_id FROM documents")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.batch_ids(_table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id"), _table(spark, sf_dir, "labels")
    return W.pending(docs, labels.where("quality = 1"), labels.where("quality = 0"), "doc_id")


@_query("SELECT doc_id, 'done' AS origin FROM labels UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id"), _table(spark, sf_dir, "labels").select("doc_id")
    return W.union_first([labels.withColumn("origin", F.lit("done")), docs.withColumn("origin", F.lit("new"))], ["doc_id"], ["doc_id"]).select("doc_id", "origin")


@_query("SELECT user_id AS url, arg_max(CASE WHEN event_type = 'click' THEN 'failed' ELSE 'done' END, event_id) AS status, count(*) AS attempts FROM events GROUP BY user_id")
def work_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _table(spark, sf_dir, "events").select(F.col("user_id").alias("url"), F.col("event_id").alias("run"), F.when(F.col("event_type") == "click", "failed").otherwise("done").alias("status"), F.col("event_type").alias("error"))
    return I.latest_status(log).select("url", "status", "attempts")


@_query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.latest_run(_table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day")), "day").select("event_id", F.col("day").cast("string"))


@_query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR")
def fresh_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    now = events.agg(F.max("ts").alias("_now"))
    return I.fresh_state(events.crossJoin(F.broadcast(now)), F.col("_now"), 24).select("event_id")


@_query("SELECT event_type AS reason, count(*) AS n FROM events GROUP BY event_type")
def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts_by(_table(spark, sf_dir, "events").withColumnRenamed("event_type", "reason"), "reason")


@_query("SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS found, (SELECT count(DISTINCT doc_id) FROM labels) AS done, count(*) AS rows, count(CASE WHEN trim(source) <> '' THEN 1 END) AS with_sku, CAST(0 AS BIGINT) AS failed_seeds, 0 AS removed FROM documents")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return A.run_summary(docs, labels, docs, 0, docs.where("doc_id is null"), "doc_id", "source")


@_query("SELECT count(*) AS total, count(*) - (SELECT count(DISTINCT doc_id) FROM labels) AS remaining, CAST(0 AS BIGINT) AS failed_seeds, false AS complete FROM documents")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return A.completeness(docs, _table(spark, sf_dir, "labels"), docs.where("doc_id is null"), "doc_id")


@_query(
    """SELECT o_custkey, md5(string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey))[1:12] AS ordered, md5(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY CAST(o_orderkey AS VARCHAR)))[1:8] AS sorted
FROM orders GROUP BY o_custkey"""
)
def job_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a seed list, in order and regardless of it."""
    o = _table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("seed"))
    in_order, any_order = I.job_signature(o, "seed", by=["o_custkey"]), I.job_signature(o, "seed", 8, False, by=["o_custkey"])
    return in_order.withColumnRenamed("job", "ordered").join(any_order.withColumnRenamed("job", "sorted"), "o_custkey")


# --- dictionaries ------------------------------------------------------------


@_query("SELECT c_custkey, coalesce(n_name, 'none') AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 3 <> 0")
def dict_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation").where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    return N.equal_lookup(_table(spark, sf_dir, "customer"), "c_nationkey", n, F.lit("none"), "nation").select("c_custkey", "nation")


@_query(
    """WITH d AS (SELECT row_number() OVER (ORDER BY word DESC) AS pos, word FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM part))
SELECT p_partkey, (SELECT arg_min(upper(word), pos) FROM d WHERE contains(p_name, word)) AS code FROM part"""
)
def dict_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = p.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word")).distinct()
    # positions from a descending sort of the vocabulary, which is a few hundred words at any size
    ranked = words.agg(F.sort_array(F.collect_list("word"), asc=False).alias("w")).select(F.posexplode("w").alias("pos", "word"))
    return N.first_contained(p, "p_name", "word", ranked.withColumn("value", F.upper("word")), "code").select("p_partkey", "code")


@_query(
    """WITH m AS (SELECT key, list_sort(list(DISTINCT value)) AS v FROM (SELECT p_size AS key, p_brand AS value FROM part UNION ALL SELECT p_size + 1, p_type FROM part) GROUP BY key)
SELECT key, array_to_string(v, ',') AS joined, len(v) AS n FROM m"""
)
def multi_value_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    m = N.multi_value(p.select(F.col("p_size").alias("key"), F.col("p_brand").alias("value")), p.select(F.col("p_size") + 1, "p_type").toDF("key", "value"))
    return m.select("key", F.array_join("values", ",").alias("joined"), F.size("values").cast("bigint").alias("n"))


@_query(
    """WITH s AS (SELECT p_partkey % 20 AS k, min(p_partkey) AS pos FROM part GROUP BY 1),
sheet AS (SELECT pos, 'C' || CAST(k AS VARCHAR) AS code, 'Name ' || CAST(k // 2 AS VARCHAR) AS english, '红' || CAST(k // 4 AS VARCHAR) || ',蓝' || CAST(k AS VARCHAR) AS chinese FROM s),
names AS (SELECT lower(english) AS key, arg_max(code, pos) AS v FROM sheet GROUP BY 1), codes AS (SELECT lower(code) AS key, arg_max(code, pos) AS v FROM sheet GROUP BY 1),
words AS (SELECT w AS key, string_agg(code, ',' ORDER BY pos) AS v FROM (SELECT pos, code, unnest(string_split(chinese, ',')) AS w FROM sheet) GROUP BY 1),
l AS (SELECT p_partkey, '红' || CAST(p_partkey % 7 AS VARCHAR) AS k1, CASE p_partkey % 3 WHEN 0 THEN 'c' || CAST(p_partkey % 30 AS VARCHAR) WHEN 1 THEN 'NAME ' || CAST(p_partkey % 15 AS VARCHAR) ELSE '' END AS k2 FROM part)
SELECT p_partkey, coalesce(codes.v, names.v, words.v, nullif(lower(k2), ''), k1) AS color FROM l LEFT JOIN codes ON lower(k2) = codes.key LEFT JOIN names ON lower(k2) = names.key LEFT JOIN words ON k1 = words.key"""
)
def color_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    k = F.col("k")
    s = p.groupBy((F.col("p_partkey") % 20).alias("k")).agg(F.min("p_partkey").alias("pos"))
    sheet = s.select("pos", F.concat(F.lit("C"), k.cast("string")).alias("code"), F.concat(F.lit("Name "), F.floor(k / 2).cast("string")).alias("english"), F.concat(F.lit("红"), F.floor(k / 4).cast("string"), F.lit(",蓝"), k.cast("string")).alias("chinese"))
    key = F.col("p_partkey")
    second = F.when(key % 3 == 0, F.concat(F.lit("c"), (key % 30).cast("string"))).when(key % 3 == 1, F.concat(F.lit("NAME "), (key % 15).cast("string"))).otherwise("")
    rows = p.select("p_partkey", F.concat(F.lit("红"), (key % 7).cast("string")).alias("k1"), second.alias("k2"))
    return N.match_color(rows, "k1", "k2", sheet, "color").select("p_partkey", "color")


@_query("SELECT p_partkey, CASE p_size WHEN 25 THEN '15.5' WHEN 26 THEN '16' WHEN 27 THEN '17' WHEN 28 THEN '17.25' WHEN 30 THEN '18.5' WHEN 33 THEN '20.5' WHEN 35 THEN '22' WHEN 36 THEN '22.5' WHEN 37 THEN '23' WHEN 38 THEN '24' WHEN 39 THEN '24.5' WHEN 40 THEN '25.25' WHEN 42 THEN '26.5' WHEN 44 THEN '28' WHEN 45 THEN '28.5' WHEN 46 THEN '29' WHEN 47 THEN '30' WHEN 48 THEN '30.5' WHEN 49 THEN '31' WHEN 17 THEN '10.5' WHEN 18 THEN '11' WHEN 21 THEN '13' END AS jp FROM part")
def size_charts_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", Z.eu_or_letter(F.col("p_size").cast("string")).alias("jp"))


# --- pages and URLs ----------------------------------------------------------

_ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


@_query(f"SELECT DISTINCT url, {_ORIGIN} || replace(l, '&amp;', '&') AS link FROM (SELECT url, unnest(regexp_extract_all(html, '<a[^>]+href=\"([^\"]+)\"', 1)) AS l FROM pages) WHERE l LIKE '/%'")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.list_links(_table(spark, sf_dir, "pages"), H.all_links).select("url", "link")


@_query(
    r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>\s*(.*?)\s*</h1>', 1), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages"""
)
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", H.title(F.col("html")).alias("title"))


@_query("SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", U.canonical_product(F.col("url"), "https://shop.example").alias("canonical"))


@_query(
    r"""SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query,
  string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')[-1] AS file, regexp_extract(url || '/12345.html?a', '/(\d+)\.html(?:$|[?#])', 1) AS model, md5(url) AS hash FROM pages"""
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", U.host_of(u).alias("host"), U.path_of(u).alias("path"), U.query_of(u).alias("query"), U.file_name(u).alias("file"), U.model_of(F.concat(u, F.lit("/12345.html?a"))).alias("model"), U.content_hash(u.cast("binary")).alias("hash"))


@_query("SELECT page_id, contains(lower(html), 'cf-turnstile') OR contains(lower(html), 'challenge-platform') AS challenge, length(html) < 30000 OR contains(lower(html[1:5000]), 'sit tight') AS failover, CASE WHEN page_id % 10 = 0 THEN 'HTTP 404' END AS error FROM pages")
def blocked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("html")
    return _table(spark, sf_dir, "pages").select("page_id", H.is_challenge(h).alias("challenge"), H.is_failover(h).alias("failover"), H.page_error(F.when(F.col("page_id") % 10 == 0, 404).otherwise(200), h).alias("error"))


@_query("SELECT doc_id, CASE WHEN regexp_matches(text, '[぀-ヿㇰ-ㇿ]') THEN 'kana' WHEN regexp_matches(text, '[一-鿿]') THEN 'han' ELSE 'other' END AS script FROM documents")
def script_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", Ti.script_class(F.col("text")).alias("script"))


@_query("WITH d AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 10 = 0) SELECT p_partkey, CASE WHEN d.p_name IS NOT NULL THEN '中' || part.p_name ELSE trim(regexp_replace(part.p_name, '\\s+', ' ', 'g')) END AS title_chn, false AS needs_translation FROM part LEFT JOIN d ON part.p_name = d.p_name")
def title_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    direct = p.where("p_partkey % 10 = 0").select(F.col("p_name").alias("source"), F.concat(F.lit("中"), "p_name").alias("target")).distinct()
    return Ti.translate(p, "p_name", direct, direct.where("false")).select("p_partkey", "title_chn", "needs_translation")


@_query("SELECT p_partkey, p_brand AS item, split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) || '-XL' AS size, CAST(p_size AS VARCHAR) || '/XL' AS spelling FROM part")
def sku_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = F.concat_ws("-", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)), F.col("p_size").cast("string"), F.lit("XL"))
    p = _table(spark, sf_dir, "part").select("p_partkey", X.sku_parts(sku).alias("p"))
    return p.select("p_partkey", "p.item", "p.color", "p.size", F.get(X.size_spellings(F.col("p.size")), F.lit(1)).alias("spelling"))


@_query("WITH s AS (SELECT user_id, event_type, CAST(count(*) AS VARCHAR) AS n FROM events GROUP BY 1, 2), l AS (SELECT user_id, list(event_type ORDER BY event_type) AS t, list(n ORDER BY event_type) AS c FROM s GROUP BY 1) SELECT user_id, " + ", ".join(f"coalesce(t[{k}], '') AS shop{k}, coalesce(c[{k}], '') AS stock{k}" for k in range(1, 6)) + " FROM l")
def store_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").cast("string").alias("n"))
    rows = per.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(F.col("event_type").alias("name"), F.col("n").alias("status")))).alias("stores"))
    return K.wide(rows, 5)


@_query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


_IMAGE = "'https://img.example/' || CAST(page_id % 5 AS VARCHAR) || CASE WHEN page_id % 3 = 0 THEN '_000_' ELSE '_B_' END || CAST(page_id AS VARCHAR) || '.jpg'"


@_query(f"WITH i AS (SELECT page_id // 20 AS product, {_IMAGE} AS u FROM pages) SELECT product, string_agg(u, ';' ORDER BY CASE WHEN contains(u, '_000_') THEN 0 ELSE 1 END, u) AS images FROM i GROUP BY product")
def gallery_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    url = F.concat(F.lit("https://img.example/"), (k % 5).cast("string"), F.when(k % 3 == 0, "_000_").otherwise("_B_"), k.cast("string"), F.lit(".jpg"))
    rows = _table(spark, sf_dir, "pages").select(F.floor(k / 20).alias("product"), url.alias("u"))
    return rows.groupBy("product").agg(F.array_join(H.gallery(F.collect_list("u")), ";").alias("images"))


@_query("SELECT page_id, 0 AS image_pos, 'a_b/m_' || CAST(page_id AS VARCHAR) || '/' || CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) || '.png' ELSE 'image_0.jpg' END AS key FROM pages")
def image_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    url = F.concat(F.lit("https://img.example/"), k, F.when(F.col("page_id") % 2 == 0, ".png?x=1").otherwise("?x=1"))
    lines = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.concat_ws("\t", F.lit("a:b"), F.concat(F.lit("m/"), k), F.concat(url, F.lit("; "))).alias("value"))
    images, _ = J.image_manifest(lines, "https://cdn.example")
    return images.select(F.col("pos").alias("page_id"), "image_pos", "key")


@_query(f"WITH {_RUNS}, c AS (SELECT *, split_part(event_type || '-' || CAST(event_id AS VARCHAR), '-', 1) AS code FROM runs) SELECT event_id, CASE WHEN first_value(value) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) > 50 THEN 'created' ELSE 'blank' END AS outcome FROM c")
def size_chart_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    e = _table(spark, sf_dir, "events")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    sheet = e.select(F.col("user_id").cast("string").alias("sheet"), place.alias("pos"), F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("Code"), F.when(F.col("value") > 50, F.concat(F.lit("<table>"), F.col("event_id").cast("string"), F.lit("</table>"))).otherwise("").alias("Description"), "event_id")
    none = sheet.select(F.lit("").alias("key"), F.lit("").alias("hash")).where("false")
    rows, _ = J.size_charts(sheet, none, F.lit("UNIQLO"), "https://cdn.example")
    return rows.select("event_id", "outcome")


@_query("SELECT conv_id, arg_min(text, turn) AS first_text, arg_max(role, turn) AS last_role, count(*) AS turns FROM conversations GROUP BY conv_id")
def conversation_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("first_text"), F.max_by("role", "turn").alias("last_role"), F.count("*").alias("turns"))


@_query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, CASE p_partkey % 4 WHEN 0 THEN '6' WHEN 1 THEN '3' WHEN 2 THEN '0' ELSE '' END AS quantity, CASE WHEN p_partkey % 3 = 0 THEN 0 WHEN p_partkey % 5 = 0 THEN 1 ELSE greatest(0, least(5, p_size - 10)) END AS live FROM part")
def stock_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    word = F.when(k % 4 == 0, "in-stock").when(k % 4 == 1, "Low-Stock").when(k % 4 == 2, "out-of-stock").otherwise("soon")
    live = M.live_quantity(k % 3 != 0, F.when(k % 5 != 0, F.col("p_size") - 10))
    return _table(spark, sf_dir, "part").select("p_partkey", M.size_text(F.col("p_size").cast("double").cast("string")).alias("size"), M.stock_quantity(word).alias("quantity"), live.alias("live"))


# --- whole jobs over pages that Spark composes from part ----------------------


def _spread_parts(spark: SparkSession, sf_dir: str, spread: bool) -> DataFrame:
    """The part table, on request dealt over all tasks before pages are made of its rows: a small file is one task's input."""
    p = _table(spark, sf_dir, "part")
    return p.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if spread else p


def _composed(parts: DataFrame, url: Column, html: Column) -> DataFrame:
    """(url, html) of each part; bound, or a page would be composed anew wherever it is read."""
    return bound(parts.select(url.alias("url"), html.alias("html")), url=F.col("url"), html=F.col("html"))


def layer_pages(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """A product page with a data layer for each part: two sizes, one in stock."""
    k, size = F.col("p_partkey").cast("string"), F.col("p_size")
    variant = lambda s, stock: F.concat(F.lit('{"productInfo":{"sku":"K'), k, F.lit('","color":"'), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit('","size":"'), s.cast("string"), F.lit('"},"attributes":{"stockStatus":"' + stock + '"}}'))
    data = F.concat(
        F.lit('{"productInfo":{"productID":"P'), k, F.lit('","productName":"'), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit('"},"price":{"displayRegularPrice":"¥ '), F.format_number(F.floor("p_retailprice"), 0),
        F.lit('","displayPrice":"'), F.floor(F.col("p_retailprice") * F.lit(0.5)).cast("string"), F.lit('"},"linkedProduct":['), variant(size, "in-stock"), F.lit(","), variant(size + 1, "out-of-stock"), F.lit(","), variant(size, "in-stock"), F.lit("]}"),
    )
    html = F.concat(F.lit("<html><h1> "), "p_name", F.lit('</h1><ol class="breadcrumb"><a href="https://shop.example/ja-jp/c/'), F.lower("p_type"), F.lit('">x</a></ol><script>digitalData.product.push('), data, F.lit(");</script></html>"))
    return _composed(_spread_parts(spark, sf_dir, spread), F.concat(F.lit("https://shop.example/p/prod"), k, F.lit(".html")), html)


@_query(
    """WITH v AS (SELECT *, unnest([0, 1]) AS d FROM part)
SELECT regexp_extract(lower(p_type), '^([^/]+)', 1) AS type, p_name AS title, 'P' || CAST(p_partkey AS VARCHAR) AS model, '' AS u_model, 'https://shop.example/p/prod' || CAST(p_partkey AS VARCHAR) || '.html' AS url, 'house' AS brand, split_part(p_name, ' ', 1) AS color,
  CAST(p_size + d AS VARCHAR) AS size, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS msrp, CAST(CAST(floor(p_retailprice * 0.5::DOUBLE) AS BIGINT) AS VARCHAR) AS discounted_price,
  CASE d WHEN 0 THEN 'in-stock' ELSE 'out-of-stock' END AS stock_status, CASE d WHEN 0 THEN '6' ELSE '0' END AS quantity FROM v"""
)
def variant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = E.variant_rows(layer_pages(spark, sf_dir, spread=True), "house", "https://images.example/is/image/")
    return rows.drop("pos")


def grouped_pages(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """A grouped product page for each part: two swatches, sizes S and M, M of the second colour out of stock."""
    k = F.col("p_partkey").cast("string")
    swatch = lambda c, oos: F.concat(F.lit(f'<button class="product-swatch" data-color="{c}" data-caption="Colour {c}" data-size-stock="[&quot;S&quot;,&quot;M&quot;]" data-product-oos="{oos}"></button>'))
    item = lambda c: F.concat(F.lit('{"@type":"Product","mpn":"'), k, F.lit(f'-{c}","sku":"'), k, F.lit(f'-{c}","color":"Colour {c}","offers":{{"price":"'), F.floor("p_retailprice").cast("string"), F.lit('","url":"/product/x/'), k, F.lit(f'.html?dwvar_'), k, F.lit(f'_color={c}"}}}}'))
    data = F.concat(F.lit('[{"@type":"ProductGroup","productGroupID":"'), k, F.lit('","name":"'), "p_name", F.lit('","brand":{"name":"House"},"color":["AAA","BBB"]},'), item("AAA"), F.lit(","), item("BBB"), F.lit("]"))
    html = F.concat(F.lit('<html><body><script type="application/ld+json">'), data, F.lit("</script>"), swatch("AAA", "{}"), swatch("BBB", "{&quot;M&quot;:&quot;4512345678901&quot;}"), F.lit("</body></html>"))
    return _composed(_spread_parts(spark, sf_dir, spread), F.concat(F.lit("https://shop.example/product/x/"), k, F.lit(".html")), html)


@_query(
    """WITH v AS (SELECT p_partkey, p_name, p_retailprice, p_size, c, z FROM part, (VALUES ('AAA'), ('BBB')) a(c), (VALUES ('S'), ('M')) b(z)),
l AS (SELECT *, CASE WHEN c = 'AAA' AND p_partkey % 2 = 0 THEN p_size END AS price, c = 'AAA' OR z = 'S' AS stock FROM v)
SELECT p_name AS title, CAST(p_partkey AS VARCHAR) || '-' || c || '-' || z AS sku, z AS size, c AS color, 'house' AS brand,
  CASE WHEN price IS NOT NULL THEN '¥ ' || CAST(price AS VARCHAR) ELSE '¥ ' || format('{:,}', CAST(round_even(floor(p_retailprice) * 1.1::DOUBLE, 0) AS BIGINT)) END AS msrp,
  CASE WHEN c = 'AAA' AND p_partkey % 2 = 0 AND z = 'S' THEN CAST(least(5, p_size) AS VARCHAR) WHEN stock THEN '1' ELSE '0' END AS quantity,
  CASE WHEN c = 'BBB' AND z = 'M' THEN 'https://shop.example/product/x/4512345678901.html' ELSE 'https://shop.example/product/x/' || CAST(p_partkey AS VARCHAR) || '.html?dwvar_' || CAST(p_partkey AS VARCHAR) || '_color=' || c END AS url
FROM l"""
)
def catalogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, _ = E.product_pages(grouped_pages(spark, sf_dir, spread=True), "https://shop.example", "house")
    live = _table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("model"), F.lit("AAA").alias("color"), F.lit("S").alias("size"), F.col("p_size").alias("ats"), F.lit(None).cast("double").alias("list"), F.col("p_size").cast("double").alias("sales"))
    return E.catalogue_rows(products, live, "https://shop.example").select("title", "sku", "size", "color", "brand", "msrp", "quantity", "url")


@_query(
    """SELECT 'https://shop.example/g/' || CAST(p_partkey AS VARCHAR) || '.html' AS url, CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 4 THEN CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS model, 'CCC' AS color, 'S,M' AS sizes, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS msrp FROM part"""
)
def generic_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("p_partkey").cast("string"), F.floor("p_retailprice").cast("string")
    item = lambda s: F.concat(F.lit('{"@type":"Product","sku":"'), k, F.lit(f'-CCC-{s}","mpn":"'), k, F.lit('-CCC","offers":{"price":"'), price, F.lit('"}}'))
    data = F.concat(F.lit('{"page":{"items":[{"@type":"Product","productGroupID":"'), k, F.lit('","name":"g"},'), item("S"), F.lit(","), item("M"), F.lit("]}}"))
    pages = _composed(_spread_parts(spark, sf_dir, True), F.concat(F.lit("https://shop.example/g/"), k, F.lit(".html")), F.concat(F.lit('<script type="application/json">'), data, F.lit("</script>")))
    return E.generic_products(pages, "house").select("url", "model", "color", F.array_join("sizes", ",").alias("sizes"), "msrp")


@_query("SELECT p_partkey // 50 AS seed, CAST(p_partkey % 50 AS INTEGER) AS step, 'https://shop.example/list/' || p_partkey AS url FROM part")
def next_page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list page for each part, in chains of fifty pages."""
    k = F.col("p_partkey")
    at = lambda c: F.concat(F.lit("https://shop.example/list/"), c.cast("string"))
    p = _table(spark, sf_dir, "part").select("p_partkey")
    more = F.when(k % 50 < 49, F.concat(F.lit('<a class="see-more-button" data-url="/list/'), (k + 1).cast("string"), F.lit('">'))).otherwise("")
    pages, seeds = p.select(at(k).alias("url"), more.alias("html")), p.where("p_partkey % 50 = 0").select(at(k).alias("seed_url"))
    return E.page_chain(pages, seeds).select(F.floor(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("bigint") / 50).alias("seed"), "step", "url")


@_query("SELECT p_brand || '-' || split_part(p_name, ' ', 1) || '-' || CAST(p_size AS VARCHAR) AS sku, split_part(p_name, ' ', 1) AS color, 'Shade' AS color_name, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price, 'A' AS shop1, 'あり' AS stock1, 'B' AS shop2, 'わずか' AS stock2 FROM part")
def store_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _spread_parts(spark, sf_dir, True)
    color = F.split_part("p_name", F.lit(" "), F.lit(1))
    sku = F.concat_ws("-", "p_brand", color, F.col("p_size").cast("string"))
    card = lambda name, rest: f'<div class="card-body x"><div class="col store-name"><a href="#">{name}</a></div>{rest}</div>'
    stores = 'class="results__stores"' + card("A", '<div class="store-availability-message">あり<div></div>') + card("B", '<i class="dot low"></i>') + card("A", "") + 'class="results__dealers"' + card("C", "")
    html = F.concat(F.lit('<h1 class="product-name">x</h1><button data-attr-value="'), color, F.lit('" data-caption="Shade"></button><span itemprop="price" content="'), F.format_number(F.floor("p_retailprice"), 0), F.lit('"></span>' + stores))
    one = bound(p.select(sku.alias("sku"), html.alias("html")), sku=F.col("sku"), html=F.col("html"))
    rows = one.select("sku", color_of_sku(F.col("sku")).alias("color"), H.color_name(F.col("html"), color_of_sku(F.col("sku"))).alias("color_name"), M.page_price(F.col("html")).alias("price"), H.stores(F.col("html")).alias("stores"))
    return K.wide(rows, 2)


def color_of_sku(sku):
    return X.sku_parts(sku)["color"]


def queries() -> dict[str, Query]:
    from . import queries_brands, queries_pages, queries_tables  # noqa: F401

    return registered()


def oracle_sql() -> dict[str, str]:
    queries()
    return registered_sql()
