"""Title normalisation with a direct dictionary and a cache of earlier translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import after_translation, before_translation, has_han, has_kana, trimmed
from .dedupe import first_rows

#: Titles with a set translation, in their normal form. Fixed values.
DIRECT_TITLES = {
    "ステンレスメッシュ キャップシェード": "不锈钢网罩",
    "ステンレスメッシュ ハット": "不锈钢网帽",
    "ステンレスメッシュ ハットシェード": "不锈钢网帽遮阳帘",
    "Montbell サンブロック ハットスクリーン": "Montbell 防晒帽屏风",
    "クール パーカ 男款": "男款凉感连帽外套",
    "クール パーカ 女款": "女款凉感连帽外套",
    "トレール アームカバー ライト 男款": "轻便男款步履护臂",
    "トレール レッグカバー ライト 女款": "轻便女款步履腿套",
    "スペリオダウンジャケット 男款": "男款 Superior 轻量羽绒夹克",
    "スペリオダウンジャケット 女款": "女款 Superior 轻量羽绒夹克",
    "EXライトダウン": "EX超轻羽绒外套",
}


def direct_titles(spark) -> DataFrame:
    return spark.createDataFrame(list(DIRECT_TITLES.items()), "source string, target string")


def translate(titles: DataFrame, column: str, direct: DataFrame, cache: DataFrame, out: str = "title_chn") -> DataFrame:
    """`titles` with the translated title and needs_translation.

    Blank titles and those with Han characters stay; the direct dictionary comes
    first; a title without kana is only cleaned; the rest is looked up in the
    cache (source, target) or marked as work, keeping its normal form.  Each
    distinct title is worked on once.
    """
    source = trimmed(F.col(column))
    names = titles.select(source.alias("_source")).where("_source <> ''").distinct()
    names = names.withColumn("_normal", F.when(~has_han(F.col("_source")), before_translation(F.col("_source"))))
    d = direct.select(F.col("source").alias("_ds"), F.col("target").alias("_direct"))
    c = cache.select(F.col("source").alias("_cs"), F.col("target").alias("_cached"))
    found = names.join(d, F.col("_normal") == F.col("_ds"), "left").join(c, F.col("_normal") == F.col("_cs"), "left")
    needs = F.col("_normal").isNotNull() & F.col("_direct").isNull() & has_kana(F.col("_normal")) & F.col("_cached").isNull()
    target = F.when(F.col("_normal").isNull(), F.col("_source")).when(F.col("_direct").isNotNull(), F.col("_direct")).when(needs, F.col("_normal")).otherwise(after_translation(F.coalesce("_cached", "_normal")))
    done = found.select("_source", target.alias(out), needs.alias("needs_translation"))
    joined = titles.drop(out, "needs_translation").withColumn("_key", source).join(done, F.col("_key") == F.col("_source"), "left")
    return joined.withColumn(out, F.when(F.coalesce(F.col("_key"), F.lit("")) == "", F.col("_key")).otherwise(F.col(out))).withColumn("needs_translation", F.coalesce("needs_translation", F.lit(False))).drop("_key", "_source")


def work_list(translated: DataFrame, out: str = "title_chn") -> DataFrame:
    """The distinct normal forms that still need a translation."""
    return translated.where("needs_translation").select(F.col(out).alias("source")).distinct()


def merge_cache(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with the new entries that it lacks, one a source."""
    fresh = first_rows(new.select("source", "target"), ["source"], ["target"]).join(cache.select("source"), "source", "left_anti")
    return cache.select("source", "target").unionByName(fresh)


def place_after(df: DataFrame, column: str, after: str) -> DataFrame:
    """`column` (added blank if missing) right behind `after`; names match in any case."""
    by_name = {c.lower(): c for c in df.columns}
    if after.lower() not in by_name:
        raise ValueError(f"no column {after}")
    if column.lower() not in by_name:
        df = df.withColumn(column, F.lit(""))
        by_name[column.lower()] = column
    own, left = by_name[column.lower()], [c for c in df.columns if c != by_name[column.lower()]]
    at = left.index(by_name[after.lower()]) + 1
    return df.select(*left[:at], own, *left[at:])


def script_class(c: Column) -> Column:
    return F.when(has_kana(c), "kana").when(has_han(c), "han").otherwise("other")
