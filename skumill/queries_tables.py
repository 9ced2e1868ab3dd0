"""Queries of text columns, of ordered tables, and of sources and sinks in round trips through the shared folder."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import schemas as S
from .functions import sizes as Z
from .functions import text as X
from .operators import dedupe as W
from .operators import lookup as N
from .operators import manifest as J
from .operators import metrics as A
from .operators import titles as Ti
from .queries import _RUNS
from .registry import query, table
from .sources import readers as R
from .sources import sinks as O
from .streaming import incremental as I


def _part(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS k", *columns)


def _in_key_order(df: DataFrame, files: int = 3) -> DataFrame:
    """Rows in the order of k, over some files whose names follow it."""
    return df.repartitionByRange(files, "k").sortWithinPartitions("k")


# --- text columns --------------------------------------------------------------


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '男款' WHEN 1 THEN '女款' WHEN 2 THEN '儿童款' ELSE '男款' END || ' ' || p_name || ' 外套' AS title, p_partkey % 4 = 0 AS by_name,
  CASE p_partkey % 3 WHEN 0 THEN 'Montbell 女款 ' || p_size || ' EX超轻' WHEN 1 THEN '凉感 ' || p_size || ', 护臂' ELSE 'Superior 连帽外套' END AS styled, CASE WHEN p_partkey % 3 = 1 THEN '女款' ELSE '男款' END AS gender FROM part"""
)
def title_wording(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gender words, protected terms and wording before and after a translation; the gender word moves to the front."""
    word = "CASE k % 4 WHEN 0 THEN ' Men''s' WHEN 1 THEN ' レディース' WHEN 2 THEN ' KIDS' ELSE ' メンズ' END"
    raw = "CASE k % 3 WHEN 0 THEN concat('Montbell ', size, ' __EX_LIGHT__ - 女士') WHEN 1 THEN concat('凉爽 ', size, ' , 臂套') ELSE '__SUPERIOR_DOWN__ 派克大衣' END"
    name = "CASE k % 3 WHEN 0 THEN '男女同款' WHEN 1 THEN '女鞋' ELSE '鞋' END"
    p = _part(spark, sf_dir, "p_name", "p_size AS size").selectExpr("k", f"concat(' ', p_name, '  风衣', {word}) AS t", f"{raw} AS raw", f"{name} AS name")
    title = X.after_translation(X.before_translation(F.col("t")))
    styled = F.regexp_replace(X.after_translation(F.col("raw")), "^女款 Montbell ", "Montbell 女款 ")
    return p.select("k", title.alias("title"), F.col("t").contains("Men's").alias("by_name"), styled.alias("styled"), X.gender_of_name(F.col("name")).alias("gender"))


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN p_size || ' g' WHEN 1 THEN p_size || '.5 kg' ELSE 'about ' || p_size END AS weight, p_name || 'outer' AS material, split_part(p_name, ' ', 1) || ' / ' || p_size AS joined,
  '<table><tr' || CASE WHEN p_partkey % 2 = 0 THEN ' bgcolor="#EEE"' ELSE '' END || '><td>' || p_name || '</td><td>' || p_size || '</td></tr></table>' AS dimension,
  CASE p_partkey % 4 WHEN 0 THEN 'in-stock' WHEN 1 THEN 'out-of-stock' WHEN 2 THEN 'soon' ELSE 'in-stock' END AS stock FROM part"""
)
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir, "p_name", "p_size").selectExpr(
        "k", "CASE k % 3 WHEN 0 THEN concat('Weight: ', p_size, ' g (9 oz)') WHEN 1 THEN concat(p_size, '.5kg') ELSE concat(' about  ', p_size, ' ') END AS w", "array(p_name, ' ', 'outer ', 'お手入れ方法: wash', 'never') AS nodes",
        "array(split_part(p_name, ' ', 1), '  ', concat(' ', p_size)) AS words", "CASE k % 4 WHEN 0 THEN 'https://schema.org/InStock' WHEN 1 THEN 'OutOfStock' WHEN 2 THEN 'soon' ELSE 'INSTOCK' END AS s",
        "concat('<table class=x><tr style=y', CASE WHEN k % 2 = 0 THEN ' bgcolor=\\\"#EEE\\\"' ELSE '' END, '><td width=9>', p_name, '</td><td><b>', p_size, '</b> </td></tr></table>') AS d",
    )
    return p.select("k", X.metric_weight(F.col("w")).alias("weight"), X.material_text(F.col("nodes")).alias("material"), X.joined_text(F.col("words"), " / ").alias("joined"), X.plain_table(F.col("d")).alias("dimension"), X.stock_word(F.col("s")).alias("stock"))


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'list' WHEN 1 THEN 'raw' WHEN 2 THEN 'styled' ELSE 'table' END AS mode, CASE WHEN p_partkey % 4 = 3 THEN '商品尺寸(cm)' END AS title,
  CASE p_partkey % 4 WHEN 0 THEN '<ul><li>W ' || p_size || '</li><li>end</li></ul>' WHEN 3 THEN '<b title="1 — 2"><span class="range">W ' || p_size || '-' || (p_size + 1) || '</span></b><br>end' ELSE '<b title="1 — 2">W ' || p_size || ' — ' || (p_size + 1) || '</b><br>end' END AS body FROM part"""
)
def chart_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in the body of a chart's document, by its brand's mode."""
    brand = "CASE k % 4 WHEN 0 THEN ' yonex' WHEN 1 THEN 'LACOSTE' WHEN 2 THEN 'Montbell ' ELSE '优衣库' END"
    text = "CASE WHEN k % 4 = 0 THEN concat(' W ', size, ' <br>end ') ELSE concat('<b title=\\\"1 — 2\\\">W ', size, ' — ', size + 1, '</b><br>end') END"
    p = _part(spark, sf_dir, "p_size AS size").selectExpr("k", f"{brand} AS brand", f"{text} AS d")
    page = J.chart_html(F.col("d"), F.col("brand"))
    body = F.regexp_extract(page, r"(?s)<body[^>]*>(?:<div[^>]*>)?(?:<div class=\"size-title\">[^<]*</div>)?(.*?)(?:</div>)?</body>", 1)
    return p.select("k", X.chart_mode(F.col("brand")).alias("mode"), X.chart_title(F.col("brand")).alias("title"), body.alias("body"))


# --- titles, charts and caches ---------------------------------------------------


@query(
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '译 ' || p_size WHEN 1 THEN 'ジャケット ' || p_size || ' 男款' WHEN 2 THEN '汉字 ' || p_size ELSE '' END AS title_chn, p_partkey % 4 = 1 AS needs_translation FROM part"""
)
def title_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles from a cache, titles that become work, and titles that stay; the new column stands right behind the old one."""
    p = _part(spark, sf_dir, "CASE p_partkey % 4 WHEN 0 THEN concat('シャツ ', p_size) WHEN 1 THEN concat('ジャケット ', p_size, ' メンズ') WHEN 2 THEN concat(' 汉字 ', p_size) ELSE ' ' END AS title", "p_size")
    old = p.where("k % 8 = 0").selectExpr("trim(title) AS source", "concat('译 ', p_size) AS target").distinct()
    new = p.where("k % 4 = 0").selectExpr("trim(title) AS source", "concat('译 ', p_size) AS target")
    got = Ti.translate(p, "title", old.where("false"), O.cache_output(Ti.merge_cache(old, new)))
    placed = Ti.place_after(got, "title_chn", "TITLE")
    assert placed.columns[placed.columns.index("title") + 1] == "title_chn"
    return placed.select("k", "title_chn", "needs_translation")


@query("SELECT DISTINCT 'ジャケット ' || p_size || ' 男款' AS source FROM part WHERE p_partkey % 4 = 1")
def title_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir, "CASE p_partkey % 4 WHEN 0 THEN concat('シャツ ', p_size) WHEN 1 THEN concat('ジャケット ', p_size, ' メンズ') ELSE concat(' 汉字 ', p_size) END AS title", "p_size")
    known = p.where("k % 4 = 0").selectExpr("trim(title) AS source", "'x' AS target").distinct()
    return Ti.work_list(Ti.translate(p, "title", known.where("false"), known))


@query(
    f"""WITH {_RUNS} SELECT event_id, CASE WHEN event_type = 'click' THEN 'reused' WHEN event_type = 'view' THEN 'blank' ELSE 'created' END AS outcome,
  CASE event_type WHEN 'click' THEN 'https://cdn.example/old/click.jpg?v=abcdefabcdef' WHEN 'view' THEN '' ELSE regexp_replace('https://cdn.example/sizetoimg/GREGORY/' || event_type || '.jpg', '$', '') END AS image FROM runs"""
)
def charts_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes whose chart is published keep it, the others get one; the version of a new chart is cut off."""
    sheet = table(spark, sf_dir, "events").selectExpr("cast(user_id AS string) AS sheet", "event_id AS pos", "event_type AS Code", "CASE WHEN event_type = 'view' THEN ' ' ELSE 'a<br>b' END AS Description", "event_id")
    listing = sheet.where("Code = 'click'").selectExpr("'old/click.jpg' AS key", "'abcdefabcdef0123' AS hash").distinct()
    rows, _ = J.size_charts(sheet, listing, F.lit("GREGORY"), "https://cdn.example")
    image = F.when(F.col("outcome") == "created", F.regexp_replace("size_image", r"[?]v=[0-9a-f]{12}$", "")).otherwise(F.col("size_image"))
    return rows.select("event_id", "outcome", image.alias("image"))


_PLACES = "CASE event_type WHEN 'click' THEN 'B1' WHEN 'view' THEN 'B2' ELSE 'B3' END"


@query(
    f"""WITH p AS (SELECT *, {_PLACES} AS brand, {_PLACES} IS DISTINCT FROM lag({_PLACES}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS chg FROM events),
r AS (SELECT *, sum(CAST(chg AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM p),
b AS (SELECT *, first_value(event_id) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS head FROM r)
SELECT event_id, CASE WHEN brand <> 'B3' AND user_id % 3 = CAST(substr(brand, 2) AS INTEGER) THEN 'reused' ELSE 'created' END AS outcome,
  CASE WHEN brand <> 'B3' AND user_id % 3 = CAST(substr(brand, 2) AS INTEGER) THEN 'https://cdn.example/sizetoimg/' || brand || '/z/u' || user_id || '.jpg?v=zzzzzzzzzzzz'
    ELSE 'https://cdn.example/sizetoimg/' || brand || '/u' || user_id || '.jpg' END AS image,
  CASE WHEN brand <> 'B3' AND user_id % 3 = CAST(substr(brand, 2) AS INTEGER) THEN NULL ELSE head END AS drawn_from FROM b"""
)
def charts_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of one name with several brands and in many runs: only the own brand's image is reused, the last of a name counts, and each run has the version of its own first row."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = table(spark, sf_dir, "events").withColumn("pos", place)
    # a code carries its brand's letter behind a hyphen, so that neighbouring brands are runs of their own
    sheet = e.selectExpr("cast(user_id AS string) AS sheet", "pos", f"concat('u', user_id, '_', {_PLACES}) AS Code", "concat('<p>', event_id, '</p>') AS Description", f"{_PLACES} AS brand", "event_id", "user_id")
    there = e.selectExpr("explode(array(struct('sizetoimg/B1/' AS at, 1 AS m), struct('sizetoimg/B2/' AS at, 2 AS m), struct('other/B3/' AS at, 0 AS m))) AS x", "user_id").where("user_id % 3 = x.m").select("x.at", "user_id").distinct()
    listing = there.selectExpr("concat(at, 'u', user_id, '_', split_part(at, '/', 2), '.jpg') AS key", "'yyyyyyyyyyyyyyyy' AS hash").unionByName(there.selectExpr("concat(at, 'z/u', user_id, '_', split_part(at, '/', 2), '.jpg') AS key", "'zzzzzzzzzzzzzzzz' AS hash"))
    rows, _ = J.size_charts(sheet, listing, F.col("brand"), "https://cdn.example", whole_code=True, folder=J.CHARTS)
    drawn = sheet.select(F.substring(F.md5(J.chart_html(F.col("Description"), F.col("brand")).cast("binary")), 1, 12).alias("_v"), F.col("event_id").alias("drawn_from"))
    got = rows.withColumn("_v", F.when(F.col("outcome") == "created", F.substring_index("size_image", "?v=", -1))).join(drawn, "_v", "left")
    image = F.when(F.col("outcome") == "created", F.regexp_replace("size_image", r"[?]v=[0-9a-f]{12}$", "")).otherwise(F.col("size_image"))
    return got.select("event_id", "outcome", F.regexp_replace(image, "_B[0-9]", "").alias("image"), "drawn_from")


@query("SELECT p_partkey AS k, 'export-20240103.csv' AS file FROM part WHERE p_partkey % 3 = 2")
def newest_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exports of a file each; only the one of the greatest name is opened."""
    path, p = O.fresh_path(spark, "exports"), _part(spark, sf_dir)
    for day in range(3):
        O.write_export(p.where(F.col("k") % 3 == day), f"{path}/export-2024010{day + 1}.csv")
    got = R.newest(spark, f"{path}/*.csv")
    return got.select(F.col("_c0").cast("long").alias("k"), F.col("_metadata.file_name").alias("file"))


@query("SELECT p_partkey AS k, 'https://cdn.example/b/m' || p_partkey || '/a.jpg' || CASE WHEN p_partkey % 2 = 0 THEN ';https://cdn.example/b/m' || p_partkey || '/image_1.jpg' ELSE '' END AS urls FROM part WHERE p_partkey % 5 <> 0")
def manifest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines with a header written, read, turned into images and folded back; short lines are rejected."""
    path = O.fresh_path(spark, "manifest")
    rows = _part(spark, sf_dir).selectExpr("k", "'b' AS brand", "CASE WHEN k % 5 = 0 THEN NULL ELSE concat('m', k) END AS model", "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN 'https://i/a.jpg; https://i/x' ELSE 'https://i/a.jpg?y' END AS urls")
    O.write_lines(rows, path, ["brand", "model", "urls"], header="brand\tmodel\turls")
    images, rejects = J.image_manifest(R.headed_lines(spark, path), "https://cdn.example")
    folded = J.manifest_lines(images).join(rejects, "pos", "left_anti")
    return folded.select(F.substring("model", 2, 20).cast("long").alias("k"), "urls")


# --- dictionaries -----------------------------------------------------------------------


@query(
    """WITH t AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), w AS (SELECT o_orderkey, (o_orderkey * 7919) % 100003 AS pos, o_orderpriority || '/' || o_orderkey AS value FROM orders),
asked AS (SELECT k, unnest([k, k + 1, k * 2]) AS o FROM t)
SELECT t.k, arg_min(value, (pos, '#' || o_orderkey || '#')) AS value FROM t LEFT JOIN asked USING (k) LEFT JOIN w ON o = o_orderkey GROUP BY t.k"""
)
def large_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order number is a word of a dictionary in an order of its own; a text holds up to three of them."""
    words = table(spark, sf_dir, "orders").selectExpr("(o_orderkey * 7919) % 100003 AS pos", "concat('#', o_orderkey, '#') AS word", "concat(o_orderpriority, '/', o_orderkey) AS value")
    texts = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS k").distinct().selectExpr("k", "concat('of #', k + 1, '# and #', k * 2, '#', k, '#.') AS t")
    return N.first_contained(texts, "t", "word", words, part_words=8_000).select("k", "value")


_HUES = [("纯黑色外套", "TRBK"), ("外套 黑色/深蓝绿", "BK/DT"), ("黑色", "BK"), ("浅卡其/褐色", "LK/TN"), ("浅卡其", "LTKH"), ("辣椒红 小", "PAP-C,PAPRIC,PAPRI"), ("绿色", "DGN,GN"), ("森林绿色", "FOST"), ("摩尔灰 L", "ML-C"), ("无", None)]


@query(
    f"""WITH hue(i, codes) AS (VALUES {", ".join(f"({i}, {'NULL' if c is None else repr(c)})" for i, (_, c) in enumerate(_HUES))})
SELECT p_partkey AS k, codes FROM part JOIN hue ON p_partkey % {len(_HUES)} = i"""
)
def colour_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of the colour word that a text holds; a longer word comes before one that it contains."""
    texts = F.array(*[F.lit(t) for t, _ in _HUES])
    p = _part(spark, sf_dir).select("k", F.get(texts, (F.col("k") % len(_HUES)).cast("int")).alias("t"))
    return p.select("k", F.array_join(Z.color_codes(F.concat(F.lit("新 "), F.col("t"))), ",").alias("codes"))


@query("SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'XXL-S' WHEN 1 THEN 'XXXLS' WHEN 2 THEN 'XXS' END AS size, CASE WHEN p_partkey % 3 = 0 THEN 'DGN,GN' WHEN p_partkey % 3 = 1 THEN 'BNSD' END AS codes FROM part")
def known_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first word of a specification that is a size of the chart, and the codes of the first that holds a colour of the dictionary."""
    color = "CASE k % 3 WHEN 0 THEN '一绿色' WHEN 1 THEN '沙土棕' ELSE '无' END"
    size = "CASE k % 4 WHEN 0 THEN 'XXL-S M' WHEN 1 THEN 'L-Q XXXLS' WHEN 2 THEN 'XXS' ELSE 'Q' END"
    p = _part(spark, sf_dir).selectExpr("k", f"split(concat({color}, ' ', {size}), ' ') AS words")
    first = lambda read: F.get(F.filter(F.transform("words", read), lambda x: x.isNotNull()), F.lit(0))
    return p.select("k", first(Z.known_size).alias("size"), F.array_join(first(lambda w: Z.color_codes(w)), ",").alias("codes"))


# --- order, groups and counters -----------------------------------------------------


@query("SELECT upper(event_type) || '-' || user_id AS kind, string_agg(event_id, ',' ORDER BY event_id) AS ids FROM events GROUP BY 1")
def grouped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each kind and user, kinds in any case, in order."""
    rows = table(spark, sf_dir, "events").selectExpr("concat(CASE WHEN event_id % 2 = 0 THEN event_type ELSE upper(event_type) END, '-', user_id) AS kind", "event_id")
    return W.grouped(rows, "kind", ["event_id"]).select("kind", F.array_join(F.transform("rows", lambda r: r["event_id"].cast("string")), ",").alias("ids"))


@query(
    """WITH g AS (SELECT *, min(event_id) OVER (PARTITION BY event_type) AS f FROM events), r AS (SELECT event_id, event_type, row_number() OVER (ORDER BY f, event_id) AS place FROM g)
SELECT event_id, event_type, place FROM r WHERE place <= 1000"""
)
def source_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by first appearance and rows by position: the head of that order, a thousand rows."""
    ordered = W.source_order(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id")
    head = ordered.limit(1000).withColumn("_at", F.monotonically_increasing_id())
    return head.select("event_id", "event_type", F.row_number().over(Window.orderBy("_at")).cast("bigint").alias("place"))


@query("WITH g AS (SELECT *, min(event_id) OVER (PARTITION BY event_type) AS f FROM events) SELECT event_id, event_type, row_number() OVER (ORDER BY f, event_id) AS place FROM g")
def source_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in the order of groups by first appearance, numbered over parts of the order."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    first = events.groupBy("event_type").agg(F.min("event_id").alias("first"))
    placed = W.batch_ids(events.join(first, "event_type"), ["first", "event_id"], 1, "place", plain_rows=0)
    return placed.select("event_id", "event_type", (F.col("place") + 1).alias("place"))


@query("SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def first_rows_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "value", "-value AS _down")
    return W.first_n(rows, ["_down", "event_id"], 25).select("event_id", "value")


@query("SELECT p_partkey AS k, array_to_string(CASE WHEN p_partkey % 3 = 0 THEN ['S', 'M'] WHEN p_partkey % 3 = 1 THEN ['M', 'L', 'S'] ELSE ['L', 'M', 'S'] END, ',') AS sizes FROM part")
def size_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir).selectExpr("k", "CASE k % 3 WHEN 0 THEN array('S') WHEN 1 THEN array('M', 'L') END AS a", "CASE k % 3 WHEN 0 THEN array('M', 'S') WHEN 1 THEN array('S', 'M') ELSE array('L', 'M') END AS b", "CASE k % 3 WHEN 2 THEN array('M', 'S') ELSE array() END AS c")
    return p.select("k", F.array_join(W.ordered_union(F.col("a"), F.col("b"), F.col("c")), ",").alias("sizes"))


@query("SELECT l.doc_id, quality FROM (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l JOIN (SELECT DISTINCT doc_id FROM documents) d ON l.doc_id = d.doc_id")
def reused_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished results of what is wanted, in the wanted order."""
    done = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return W.reuse(table(spark, sf_dir, "documents").select("doc_id").distinct(), done, "doc_id", "doc_id").select("doc_id", "quality")


@query("SELECT CAST(sum(strlen(html)) AS BIGINT) AS total_size, count(*) AS rows, CAST(1.5 AS DOUBLE) AS list_s, CAST(2.5 AS DOUBLE) AS detail_s, CAST(4 AS DOUBLE) AS total_s FROM pages")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of a listing's objects, with stage times as columns."""
    listing = table(spark, sf_dir, "pages").select(F.octet_length("html").cast("bigint").alias("fsize"))
    return A.with_timings(A.total_size(listing).crossJoin(listing.agg(F.count("*").alias("rows"))), {"list": 1.5, "detail": 2.5})


@query("SELECT CASE WHEN event_type = 'click' THEN 'failed' WHEN value > 50 THEN 'new' ELSE 'reused' END AS outcome, count(*) AS n FROM events GROUP BY 1")
def outcome_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts_by(table(spark, sf_dir, "events").selectExpr("CASE WHEN event_type = 'click' THEN 'failed' WHEN value > 50 THEN 'new' ELSE 'reused' END AS outcome"), "outcome")


# --- sources and sinks ----------------------------------------------------------------


@query("SELECT 'https://h/' || k AS seed_url, place - 1 AS pos FROM (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) AS place FROM part) WHERE k % 4 <> 0 AND k % 7 <> 0")
def seed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed list of several files: comments and blank lines go, positions count every line."""
    path = O.fresh_path(spark, "seeds")
    line = "CASE WHEN k % 4 = 0 THEN concat('# ', k) WHEN k % 7 = 0 THEN '  ' ELSE concat(' https://h/', k, ' ') END AS value"
    _in_key_order(_part(spark, sf_dir)).selectExpr(line).write.text(path)
    return R.seed_list(spark, path).select("seed_url", "pos")


@query("SELECT p_brand || '-' || p_partkey AS sku FROM part WHERE p_partkey % 3 <> 0")
def sku_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sku_table(_part(spark, sf_dir, "p_brand").selectExpr("k", "CASE WHEN k % 6 = 0 THEN ' ' WHEN k % 3 = 0 THEN NULL ELSE concat(' ', p_brand, '-', k, ' ') END AS SKU")).select("sku")


@query("SELECT p_brand AS model, CAST(p_size AS VARCHAR) AS size, p_retailprice AS msrp, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice / 2 END AS discounted_price, p_name AS color, CAST(p_partkey % 7 AS INTEGER) AS quantity FROM part")
def supply_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supply table by column position from files with a header each."""
    path = O.fresh_path(spark, "supply")
    rows = _part(spark, sf_dir, "p_brand", "p_size", "p_retailprice", "p_name")
    _in_key_order(rows).selectExpr("p_brand AS a", "p_size AS b", "p_retailprice AS c", "CASE WHEN k % 3 = 0 THEN '-' ELSE cast(p_retailprice / 2 AS string) END AS d", "p_name AS e", "k % 7 AS f", "'r' AS g").write.csv(path, header=True)
    return R.supply_table(spark, path).select("model", "size", "msrp", "discounted_price", "color", "quantity")


@query("SELECT 'S' || p_partkey AS sku_id, p_brand AS article, CAST(p_size AS INTEGER) AS lead_time, CAST(p_partkey AS DOUBLE) AS my_bid FROM part")
def listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reconciled listing written in its column order and read again by position, behind three lead rows a file."""
    path = O.fresh_path(spark, "listing")
    rows = _part(spark, sf_dir, "p_brand", "p_size").selectExpr("k", "concat('S', k) AS sku_id", "p_brand AS article", "p_size AS lead_time", "cast(k AS double) AS my_bid")
    whole = O.listing_output(rows.drop("k")).select(*S.LISTING_POSITIONS[:39])
    lead = whole.limit(1).select(*[F.lit("lead").alias(c) for c in whole.columns])
    texts = [F.col(c).cast("string").alias(c) for c in whole.columns]
    lead.unionByName(lead).unionByName(lead).unionByName(whole.select(*texts)).coalesce(1).write.csv(path)
    return R.listing_table(spark, path).select("sku_id", "article", "lead_time", "my_bid")


@query("SELECT DISTINCT 'https://shop.example/product/a/' || (p_partkey // 2) || '.html' AS url FROM part")
def product_url_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product URLs in any cell of a sheet, canonical and once each."""
    sheet = _part(spark, sf_dir, "p_name").selectExpr("p_name", "CASE WHEN k % 2 = 0 THEN concat('/product/a/', k div 2, '.html?u=', k) ELSE 'none' END AS `a b`", "concat(' https://shop.example/product/a/', k div 2, '.html#x') AS c")
    return R.product_urls(sheet, "https://shop.example").select("url")


@query("SELECT user_id AS url, max(event_id) AS last, count(*) AS n FROM events GROUP BY user_id")
def work_log_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log appended in two runs, the later one smaller: the last line of a key counts."""
    path = O.fresh_path(spark, "log")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "cast(user_id AS string) AS url", "array(cast(event_id AS string)) AS rows")
    last = events.groupBy("url").agg(F.max("event_id").alias("event_id"), F.max_by("rows", "event_id").alias("rows"), F.count("*").alias("n"))
    O.append_log(events.join(last.select("event_id"), "event_id", "left_anti"), path, order="event_id", run=1)
    O.append_log(last.select("event_id", "url", "rows").coalesce(1), path, order="event_id", run=2)
    got = R.work_log(spark, path)
    return got.join(last.select("url", "n"), "url").select(F.col("url").cast("bigint").alias("url"), F.col("rows")[0].cast("bigint").alias("last"), "n")


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'HTTP 404' WHEN page_id % 7 = 0 THEN 'empty body' END AS error, CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 THEN 0 ELSE length(html) END AS n FROM pages")
def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched bytes with broken UTF-8 in them become text or a failure."""
    body = "CASE WHEN page_id % 7 = 0 THEN NULL ELSE concat(cast(html AS binary), X'FF', X'C3') END AS body"
    good, bad = R.pages(table(spark, sf_dir, "pages").selectExpr("cast(page_id AS string) AS url", "CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END AS status", body))
    both = good.select("url", F.lit(None).cast("string").alias("error"), F.length("html").cast("bigint").alias("n")).unionByName(bad.select("url", "error", F.lit(0).cast("bigint").alias("n")))
    return both.select(F.col("url").cast("bigint").alias("page_id"), "error", "n")


@query("SELECT CAST(p_partkey AS VARCHAR) AS sku, coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_name END, '') AS title, '' AS weight FROM part")
def written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a declared order of columns, missing cells blank."""
    path = O.fresh_path(spark, "rows")
    O.write_rows(_part(spark, sf_dir, "p_name").selectExpr("k AS sku", "CASE WHEN k % 2 = 0 THEN p_name END AS title"), path, ["title", "sku", "weight"])
    return spark.read.parquet(path).select("sku", "title", "weight")


@query("SELECT p_partkey AS k, '20240102' AS run_ts FROM part WHERE p_partkey % 2 = 0")
def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of two brands, each under its stamp; a brand's newest counts, and failures have tables of their own."""
    path, failed = O.fresh_path(spark, "runs"), O.fresh_path(spark, "failed")
    rows = _part(spark, sf_dir)
    O.write_run(rows, path, "20240101", "x")
    O.write_run(rows.where("k % 2 = 0"), path, "20240102", "x")
    failures = rows.selectExpr("cast(k AS string) AS url", "'late' AS error")
    O.append_errors(failures, failed, "20240101")
    O.append_errors(failures, failed, "20240102")
    kinds = T.StructType([T.StructField("k", T.LongType()), T.StructField("run_brand", T.StringType()), T.StructField("run_ts", T.StringType())])
    got = O.latest_run(spark.read.schema(kinds).parquet(path), "run_ts", ["run_brand"])
    return got.join(spark.read.parquet(failed).selectExpr("cast(url AS long) AS k", "time AS run_ts"), ["k", "run_ts"], "left_semi").select("k", "run_ts")


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'x y/z' ELSE 'y' END AS brand, CASE WHEN p_partkey % 2 = 0 THEN '20240102' ELSE '20240101' END AS run_ts, 2 AS dropped FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 1")
def current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest committed run of two brands; a run written twice counts once, one without a commit not at all, and both kinds of old runs are deleted."""
    path, rows = O.fresh_path(spark, "snapshots"), _part(spark, sf_dir)
    O.write_run(rows, path, "20240101", "x y/z")
    for _ in range(2):
        O.write_run(rows.where("k % 2 = 0"), path, "20240102", "x y/z")
    O.write_run(rows.where("k % 2 = 1 AND k % 3 = 1"), path, "20240101", "y")
    rows.withColumn("run_brand", F.lit("y")).withColumn("run_ts", F.lit("20240103")).write.mode("append").partitionBy("run_brand", "run_ts").parquet(path)  # never committed
    dropped = O.drop_old_runs(spark, path)
    return O.current_runs(spark, path).select("k", F.col("run_brand").alias("brand"), F.col("run_ts").cast("string").alias("run_ts"), F.lit(dropped).alias("dropped"))


# --- work that goes on where it ended -----------------------------------------------------


@query("SELECT user_id AS url, arg_max(CASE WHEN event_type = 'click' THEN 'failed' ELSE 'done' END, event_id) AS status, count(*) AS attempts FROM events GROUP BY user_id")
def incremental_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream worked off twice: the second call takes the new files only, and the statuses are those of one run."""
    source, state, out = (O.fresh_path(spark, n) for n in ("source", "state", "statuses"))
    events = table(spark, sf_dir, "events").selectExpr("user_id AS url", "event_id AS at", "CASE WHEN event_type = 'click' THEN 'failed' ELSE 'done' END AS status", "event_type AS error")
    for half in (0, 1):
        events.where(F.col("at") % 2 == half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        I.run_incremental(stream, state, I.upsert_status(out), snapshot=f"{out}-snapshot")
    log = spark.read.parquet(out).drop("run").withColumnRenamed("at", "run")
    return I.latest_status(log).select("url", "status", "attempts")


@query(
    """WITH s AS (SELECT user_id, arg_max(event_type, event_id) AS last, count(*) AS n FROM events WHERE user_id % 3 <> 0 GROUP BY user_id),
w AS (SELECT DISTINCT user_id FROM events)
SELECT w.user_id AS url, last IS NULL OR last NOT IN ('click', 'view') AS goes_on, last IS NULL OR last <> 'view' AS with_retry FROM w LEFT JOIN s USING (user_id)"""
)
def resumed_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run takes up: not what is done, and what has failed only on request."""
    events = table(spark, sf_dir, "events")
    wanted = events.selectExpr("user_id AS url").distinct()
    log = events.where("user_id % 3 <> 0").selectExpr("user_id AS url", "event_id AS run", "CASE event_type WHEN 'click' THEN 'failed' WHEN 'view' THEN 'done' ELSE 'started' END AS status", "event_type AS error")
    todo, retried = (I.resume(wanted, log, again).withColumn("_there", F.lit(True)) for again in (False, True))
    marked = wanted.join(todo.withColumnRenamed("_there", "_a"), "url", "left").join(retried.withColumnRenamed("_there", "_b"), "url", "left")
    return marked.select("url", F.coalesce("_a", F.lit(False)).alias("goes_on"), F.coalesce("_b", F.lit(False)).alias("with_retry"))


@query("SELECT user_id AS url, user_id % 2 = 0 AS kept, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY user_id")
def finished_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The work state of a complete job is deleted, that of an incomplete one stays."""
    paths = [O.fresh_path(spark, "job-state") for _ in range(2)]
    for half, path in enumerate(paths):
        table(spark, sf_dir, "events").where(F.col("user_id") % 2 == half).selectExpr("user_id AS url", "event_id").write.parquet(path)
    kept = [path for half, path in enumerate(paths) if not O.drop_finished(spark, path, complete=half == 1)]
    there = R.file_listing(spark, f"{O.fresh_path(spark, 'job-state').rsplit('/', 1)[0]}/job-state-*/*").select(F.element_at(F.split("path", "/"), -2).alias("job")).distinct()
    left = there.where(F.col("job").isin(*[p.rsplit("/", 1)[1] for p in paths])).count()
    return spark.read.parquet(*kept).groupBy("url").agg(F.count("*").alias("n")).select("url", F.lit(left == 1).alias("kept"), "n")


_STREAK = """WITH b AS (SELECT *, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS bad FROM events),
k AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS block FROM b),
s AS (SELECT user_id, event_id, CASE WHEN bad = 1 THEN sum(bad) OVER (PARTITION BY user_id, block ORDER BY event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS streak FROM k)
SELECT CAST(user_id AS VARCHAR) AS host, event_id AS ts, CAST(streak AS INTEGER) AS streak, CASE WHEN streak >= 3 THEN 'abort' ELSE 'pause' END AS alert FROM s WHERE streak >= 2"""


@query(_STREAK)
def streaming_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of failures in a row from a stream with a state for each host."""
    source, out, state = (O.fresh_path(spark, n) for n in ("hosts", "alerts", "state"))
    log = table(spark, sf_dir, "events").selectExpr("cast(user_id AS string) AS host", "event_id AS ts", "event_type = 'click' AS failed")
    log.write.parquet(source)
    alerts = I.streak_stream(spark.readStream.schema(log.schema).parquet(source), every=2, abort=3)
    alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("host string, ts bigint, streak int, alert string").parquet(out)


@query(_STREAK)
def batch_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").selectExpr("cast(user_id AS string) AS host", "event_id AS ts", "event_type = 'click' AS failed")
    marked = W.failure_streaks(log, ["host"], ["ts"], F.col("failed"))
    return W.streak_alerts(marked, every=2, abort=3).where("streak >= 2").select("host", "ts", F.col("streak").cast("int"), "alert")


@query(
    """WITH b AS (SELECT *, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS bad, ts - lag(ts) OVER w > INTERVAL 36 HOURS AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT *, sum(CASE WHEN bad = 0 OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block FROM b),
s AS (SELECT *, CASE WHEN bad = 1 THEN sum(bad) OVER (PARTITION BY user_id, block ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS streak FROM k)
SELECT CAST(user_id AS VARCHAR) AS host, event_id AS id, CAST(streak AS INTEGER) AS streak, CASE WHEN streak >= 3 THEN 'abort' ELSE 'pause' END AS alert FROM s WHERE streak >= 2"""
)
def late_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream whose rows arrive up to five hours late, over several batches: as if they had come in order; a host that is silent for 36 hours starts anew."""
    source, out, state = (O.fresh_path(spark, n) for n in ("hosts", "alerts", "state"))
    log = table(spark, sf_dir, "events").selectExpr("cast(user_id AS string) AS host", "cast(ts AS timestamp) AS ts", "event_id AS id", "event_type = 'click' AS failed")
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("id"), F.lit(5 * 3600))
    first, last = log.agg(F.min(arrival), F.max(arrival)).first()
    batch = F.floor((arrival - first) * 3 / (last - first + 1))
    end = spark.sql("SELECT 'end' AS host, timestamp'2200-01-01' AS ts, -1L AS id, false AS failed, 3L AS batch")
    log.withColumn("batch", batch).unionByName(end).write.partitionBy("batch").parquet(f"{source}-all")
    for k in range(4):  # files are read in the order in which they were written
        spark.read.parquet(f"{source}-all/batch={k}").repartition(4).write.mode("append").parquet(source)
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, I.ROCKSDB)
    try:
        rows = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 4).parquet(source)
        alerts = I.ordered_streak_stream(rows, late="6 hours", idle=timedelta(hours=36), every=2, abort=3)
        alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    return spark.read.schema("host string, ts timestamp, id bigint, streak int, alert string").parquet(out).drop("ts")
