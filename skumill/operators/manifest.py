"""Manifests of size charts and product images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chart_mode, chart_title, code_prefix, range_dashes, trimmed
from ..functions.urls import object_key, unversioned, versioned
from .dedupe import batch_ids, first_rows, with_runs

#: Page head of every chart; a chart is 390 pixels wide. Fixed values.
_HEAD = '<!DOCTYPE html><html><head><meta charset="utf-8"><meta name="viewport" content="width=device-width, initial-scale=1"><style>html,body{margin:0;padding:0;background:#ffffff}body{width:390px;padding:8px;color:#222222;font-size:14px}'
_TABLE_STYLE = "table+table{margin-top:12px}.size-wrap th,.size-wrap td{border:1px solid #dddddd;text-align:left;padding:4px 5px;overflow-wrap:anywhere}th{background-color:#f2f2f2}.range{white-space:nowrap}"
_RANGE_STYLE = ".size-wrap table{table-layout:auto !important}.size-wrap th,.size-wrap td{overflow-wrap:normal !important;word-break:normal !important}"
_LIST_STYLE = "ul{list-style-type:none;margin:0;padding:0}li{margin:2px 0}"

#: Where charts are published, a folder for each brand. Fixed value.
CHARTS = "sizetoimg"


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise for columns that a job needs and the table lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def chart_html(description: Column, brand: Column) -> Column:
    """The chart page of a description in its brand's mode: table, list, raw or styled."""
    text = F.coalesce(description, F.lit(""))
    ranged = range_dashes(text)
    title = chart_title(brand)
    heading = F.when(title.isNotNull(), F.concat(F.lit('<div class="size-title">'), title, F.lit("</div>"))).otherwise("")
    spans = F.when(ranged.contains('class="range"'), _RANGE_STYLE).otherwise("")
    table = F.concat(F.lit(_HEAD + _TABLE_STYLE), spans, F.lit('</style></head><body><div class="size-wrap">'), heading, ranged, F.lit("</div></body></html>"))
    items = F.array_join(F.transform(F.split(text, "<br>"), lambda x: F.concat(F.lit("<li>"), trimmed(x), F.lit("</li>"))), "")
    listed = F.concat(F.lit("<ul>"), F.when(description.isNotNull(), items).otherwise(""), F.lit("</ul>"))
    page = lambda body: F.concat(F.lit(_HEAD + _LIST_STYLE + '</style></head><body><div class="mobile-content">'), body, F.lit("</div></body></html>"))
    styled = F.concat(F.lit(_HEAD + '</style></head><body class="mobile-canvas">'), text, F.lit("</body></html>"))
    mode = chart_mode(brand)
    return F.when(mode == "list", page(listed)).when(mode == "raw", page(text)).when(mode == "styled", styled).otherwise(table)


def size_charts(sheet: DataFrame, listing: DataFrame, brand: Column, base: str, whole_code: bool = False, reuse: bool = True, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sheet with size_image and outcome, charts to publish).

    `sheet` has sheet, pos, Code and Description; `listing` the published objects
    (key, hash).  Within a sheet a run of equal codes has the chart of its first
    row; a blank description leaves the run without one.  A code whose image is
    published keeps it if `reuse`: with `folder` (`CHARTS` is where charts are
    published) only images of the row's own brand under it count, without one an
    image of that name anywhere does.

    A code that comes back in a later run of its sheet gets that run's own image
    address; both have one key, and of the charts under it the last run's is
    published.
    """
    require_columns(sheet, "sheet", "pos", "Code", "Description")
    code = code_prefix(F.col("Code"), whole_code)
    rows = sheet.drop("size_image", "outcome").withColumn("_code", F.nullif(code, F.lit(""))).withColumn("_brand", brand)
    if reuse:
        there = existing_images(listing, base, folder).select(F.col("brand").alias("_owner"), F.col("file").alias("_file"), F.col("url").alias("_there"))
        same = F.concat(F.col("_code"), F.lit(".jpg")) == F.col("_file")
        rows = rows.join(there, same & (F.col("_brand") == F.col("_owner")) if folder else same, "left").drop("_file", "_owner")
    else:
        rows = rows.withColumn("_there", F.lit(None).cast("string"))
    coded = with_runs(rows.where("_code is not null"), ["sheet"], ["pos"], F.col("_code"), "_run")
    first = first_rows(coded.where("_there is null").select("sheet", "_run", "pos", "_code", "_brand", "Description"), ["sheet", "_run"], ["pos"])
    first = first.withColumn("_made", F.coalesce(trimmed(F.col("Description")), F.lit("")) != "")
    key = F.concat_ws("/", F.lit(CHARTS), "_brand", F.concat("_code", F.lit(".jpg")))
    charts = first.where("_made").select("sheet", "_run", F.col("_code").alias("code"), key.alias("key"), chart_html(F.col("Description"), F.col("_brand")).alias("html"))
    charts = charts.withColumn("hash", F.md5(F.col("html").cast("binary"))).withColumn("url", versioned(base, F.col("key"), F.col("hash")))
    made = first.select("sheet", "_run", "_made").join(charts.select("sheet", "_run", F.col("url").alias("_new")), ["sheet", "_run"], "left")
    out = coded.join(made, ["sheet", "_run"], "left")
    image = F.coalesce("_there", F.when(F.col("_made"), F.col("_new")), F.lit(""))
    outcome = F.when(F.col("_there").isNotNull(), "reused").when(F.col("_made"), "created").otherwise("blank")
    none = rows.where("_code is null").select(*sheet.columns, F.lit("").alias("size_image"), F.lit("no code").alias("outcome"))
    last = charts.groupBy("sheet", "key").agg(F.max_by(F.struct("code", "html", "hash", "url"), "_run").alias("_c")).select("sheet", "_c.code", "key", "_c.html", "_c.hash", "_c.url")
    return out.select(*sheet.columns, image.alias("size_image"), outcome.alias("outcome")).unionByName(none), last


def existing_images(listing: DataFrame, base: str, folder: str | None = None) -> DataFrame:
    """(brand, file, url) of the published .jpg objects, with their content version.

    With `folder`, objects under folder/<brand>/ at any depth, by brand and file
    name; without, all objects by file name, and no brand.  Of objects with one name
    the last by key counts.
    """
    parts = F.split("key", "/")
    own = listing.where(F.col("key").endswith(".jpg"))
    if folder:
        own = own.where(F.col("key").startswith(folder + "/") & (F.size(parts) > 2))
    named = own.select((F.get(parts, F.lit(1)) if folder else F.lit(None).cast("string")).alias("brand"), F.element_at(parts, -1).alias("file"), "key", versioned(base, F.col("key"), F.col("hash")).alias("url"))
    return named.groupBy("brand", "file").agg(F.max_by("url", "key").alias("url"))


def refresh_batches(urls: DataFrame, size: int = 60) -> DataFrame:
    """(url, batch_id): unversioned URLs in batches of `size`."""
    return batch_ids(urls.select(unversioned(F.col("url")).alias("url")).distinct().withColumn("_n", F.xxhash64("url")), "_n", size).drop("_n")


def image_manifest(lines: DataFrame, base: str, published: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(images, rejects) of rows (pos, value) of a tab-separated text brand, model, urls (joined by semicolons).

    images: pos, brand, model, image_pos, source_url, key, url.  A line with
    fewer than three fields or no URL is rejected with its reason.  With
    `published` (key), images that are not there have a null url.
    """
    parts = F.split(trimmed(F.col("value")), "\t")
    rows = lines.select("pos", F.col("value").alias("line"), F.size(parts).alias("_n"), *[F.get(parts, F.lit(k)).alias(c) for k, c in enumerate(("brand", "model", "_urls"))])
    urls = F.filter(F.transform(F.split("_urls", ";"), lambda v: F.trim(v)), lambda u: u != "")
    rows = rows.withColumn("_list", urls)
    bad = F.when(F.col("_n") < 3, F.concat(F.lit("malformed line: "), "line")).when(F.size("_list") == 0, F.concat(F.lit("no image URL: "), "brand", F.lit("/"), "model"))
    rejects = rows.withColumn("reason", bad).where("reason is not null").select("pos", "reason")
    good = rows.where(bad.isNull()).select("pos", "brand", "model", F.posexplode("_list").alias("image_pos", "source_url"))
    images = good.withColumn("key", object_key(F.col("brand"), F.col("model"), F.col("source_url"), F.col("image_pos")))
    if published is not None:
        images = images.join(published.select(F.col("key").alias("_k")).distinct(), F.col("key") == F.col("_k"), "left")
        return images.withColumn("url", F.when(F.col("_k").isNotNull(), versioned(base, F.col("key"), F.lit("")))).drop("_k"), rejects
    return images.withColumn("url", versioned(base, F.col("key"), F.lit(""))), rejects


def manifest_lines(images: DataFrame) -> DataFrame:
    """(pos, brand, model, source_urls, urls): one row a line, URLs joined by semicolons in order."""
    of = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("image_pos", c))), lambda x: x[c]), ";")
    return images.groupBy("pos", "brand", "model").agg(of("source_url").alias("source_urls"), of("url").alias("urls"))
