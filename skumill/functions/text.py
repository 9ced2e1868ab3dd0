"""Text columns: cleaning, normal forms and small classifiers."""

from __future__ import annotations

import html
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities that `clean_text` replaces without Python. Fixed values.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&yen;": "¥", "&copy;": "©", "&reg;": "®", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}

#: Gender words and what they become, tried in this order. Fixed values.
GENDER_WORDS = [
    (r"(?iU)\bmen'?s\b", "男款"),
    (r"(?iU)\bwomen'?s\b", "女款"),
    (r"(?iU)\bkid'?s\b", "儿童款"),
    (r"(?iU)\bkids\b", "儿童款"),
    (r"(?U)\bメンズ\b", "男款"),
    (r"(?U)\bウィメンズ\b", "女款"),
    (r"(?U)\bレディース\b", "女款"),
    (r"(?U)\bキッズ\b", "儿童款"),
]

#: Brand terms that a translator must not touch, with their placeholders. Fixed values.
PROTECTED_TERMS = {
    "montbell": "Montbell",
    "wic.": "__WIC__",
    "geoline": "__GEOLINE__",
    "superior down": "__SUPERIOR_DOWN__",
    "trail action": "__TRAIL_ACTION__",
    "zeo-line": "__ZEO_LINE__",
    "dry-tec": "__DRY_TEC__",
    "dry tec": "__DRY_TEC__",
    "ex light": "__EX_LIGHT__",
}

#: Wording after translation, applied in this order. Fixed values.
STYLE_WORDS = [
    ("__WIC__", "WIC."),
    ("__GEOLINE__", "Geoline"),
    ("__SUPERIOR_DOWN__", "Superior"),
    ("__TRAIL_ACTION__", "Trail Action"),
    ("__ZEO_LINE__", "ZEO-LINE"),
    ("__DRY_TEC__", "Dry-Tec"),
    ("__EX_LIGHT__", "EX超轻"),
    (r"(?U)\b男士\b", "男款"),
    (r"(?U)\b女士\b", "女款"),
    (r"(?U)\b儿童\b", "儿童款"),
    (r"(?U)\b男袜\b", "男款"),
    (r"(?U)\b女袜\b", "女款"),
    (r"(?U)\b派克大衣\b", "连帽外套"),
    (r"(?U)\b派克外套\b", "连帽外套"),
    (r"(?U)\b风衣\b", "外套"),
    (r"(?U)\b帽檐护帘\b", "帽屏风"),
    (r"(?U)\b帽屏\b", "帽屏风"),
    (r"(?U)\b护臂套\b", "护臂"),
    (r"(?U)\b臂套\b", "护臂"),
    (r"(?U)\b袖套\b", "护臂"),
    (r"(?U)\b凉爽\b", "凉感"),
    (r"(?U)\b不锈钢网眼帽\b", "不锈钢网帽"),
    (r"(?U)\b不锈钢网眼\b", "不锈钢网"),
    (r"(?U)\b越野 护臂 轻量\b", "轻便步履护臂"),
    (r"(?U)\b越野 腿套 轻量\b", "轻便步履腿套"),
    (r"(?U)\b美利奴羊毛高山袜 男款\b", "男款美利奴羊毛高山袜"),
    (r"(?U)\b美利奴羊毛高山袜 女款\b", "女款美利奴羊毛高山袜"),
]

KANA = "[\\x{3040}-\\x{30ff}\\x{31f0}-\\x{31ff}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that it may use several times: the variable of a lambda is not put in place of each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


HAN = "[\\x{4e00}-\\x{9fff}]"

#: Chart modes by brand. Fixed values.
LIST_BRANDS = ("YONEX", "SWANS", "GREGORY", "HELLYHANSEN", "THENORTHFACE", "DESCENTE", "ASICS", "MIZUNO", "OAKLEY", "UNDERARMOUR")
RAW_BRANDS = ("LACOSTE",)
STYLED_BRANDS = ("MONTBELL",)
#: Titles over a brand's table chart. Fixed values.
TABLE_TITLES = {"UNIQLO": "商品尺寸(cm)", "优衣库": "商品尺寸(cm)", "昂跑": "推荐尺码表(cm)", "ON": "推荐尺码表(cm)", "ON RUNNING": "推荐尺码表(cm)", "PATAGONIA": "商品尺寸表(cm)", "巴塔哥尼亚": "商品尺寸表(cm)"}
#: Store stock words by dot class. Fixed values.
DOT_WORDS = {"in": "あり", "low": "わずか", "out": "なし"}


def lookup(values: dict, key: Column) -> Column:
    """The value of a literal dictionary, null where it lacks the key."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def trimmed(c: Column) -> Column:
    """Without white space at the ends, ideographic and no-break spaces included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def one_space(c: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def nonblank(c: Column) -> Column:
    """Null for an empty text."""
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return nonblank(F.regexp_extract(c, pattern, group))


def unescape_entities(c: Column) -> Column:
    """Every HTML entity, in Arrow batches; for pages whose text goes beyond ENTITIES."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(html.unescape, na_action="ignore")

    return run(c)


def clean_text(c: Column, every_entity: bool = False) -> Column:
    """Tags as spaces, entities unescaped, white space collapsed."""
    bare = F.regexp_replace(c, "<[^>]+>", " ")
    bare = unescape_entities(bare) if every_entity else reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), bare)
    return one_space(bare)


def joined_text(nodes: Column, separator: str = "\n") -> Column:
    """Text nodes that are not blank, each collapsed, joined."""
    return F.array_join(F.filter(F.transform(nodes, one_space), lambda x: x != ""), separator)


def metric_weight(c: Column) -> Column:
    """`142 g (5 oz)` as `142 g`; without a metric weight the collapsed text."""
    pattern = r"(?i)([\d.,]+)\s*(kg|g|グラム)"
    return F.when(c.rlike(pattern), F.concat_ws(" ", F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2))).otherwise(one_space(F.coalesce(c, F.lit(""))))


def material_text(nodes: Column, heading: str = "お手入れ方法") -> Column:
    """Text nodes before the first that starts with the care heading, joined."""
    clean = F.filter(F.transform(nodes, one_space), lambda x: x != "")
    stop = F.array_position(F.transform(clean, lambda x: x.startswith(heading)), True)
    return F.array_join(F.when(stop > 0, F.slice(clean, F.lit(1), (stop - 1).cast("int"))).otherwise(clean), "")


def plain_table(markup: Column) -> Column:
    """A table rebuilt as bare <table><tr><td>, keeping only a row's bgcolor; '' without rows.

    Cells keep an ideographic space; other white space at their ends goes.
    """
    rows = F.regexp_extract_all(markup, F.lit(r"(?is)(<tr\b.*?)(?=<tr\b|</table|</tr>|$)"), F.lit(1))

    def row(tr: Column) -> Column:
        cells = F.regexp_extract_all(tr, F.lit(r"(?is)<td\b[^>]*>(.*?)(?=<td\b|</td>|$)"), F.lit(1))
        body = F.array_join(F.transform(cells, lambda td: F.concat(F.lit("<td>"), F.regexp_replace(F.regexp_replace(td, "<[^>]+>", ""), r"^[ \t\r\n]+|[ \t\r\n]+$", ""), F.lit("</td>"))), "")
        color = F.regexp_extract(tr, r"(?is)^<tr\b[^>]*?bgcolor=[\"']?([^\"'\s>]+)", 1)
        return F.when(F.size(cells) > 0, F.concat(F.when(color != "", F.concat(F.lit('<tr bgcolor="'), color, F.lit('">'))).otherwise(F.lit("<tr>")), body, F.lit("</tr>")))

    built = F.filter(F.transform(rows, row), lambda x: x.isNotNull())
    return F.when(F.size(built) > 0, F.concat(F.lit("<table>"), F.array_join(built, ""), F.lit("</table>"))).otherwise(F.lit(""))


def sku_parts(sku: Column) -> Column:
    """struct(item, color, size, error) of `item-color-size`; the size keeps its own hyphens."""
    parts = F.split(trimmed(sku), "-")
    good = F.size(parts) >= 3
    return F.struct(
        F.when(good, parts[0]).alias("item"),
        F.when(good, F.get(parts, F.lit(1))).alias("color"),
        F.when(good, F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "-")).alias("size"),
        F.when(~good | sku.isNull(), F.concat(F.lit("not item-color-size: "), F.coalesce(sku, F.lit("")))).alias("error"),
    )


def size_spellings(size: Column) -> Column:
    """`L-XL` as [L-XL, L/XL]; without a hyphen the size alone."""
    return F.array_distinct(F.array(size, F.replace(size, F.lit("-"), F.lit("/"))))


def gender_words(c: Column) -> Column:
    return one_space(reduce(lambda x, p: F.regexp_replace(x, *p), GENDER_WORDS, c))


def protect_terms(c: Column) -> Column:
    quoted = lambda s: "(?i)" + s.replace(".", r"\.")
    return reduce(lambda x, p: F.regexp_replace(x, quoted(p[0]), p[1]), PROTECTED_TERMS.items(), c)


def before_translation(c: Column) -> Column:
    """The normal form that dictionaries and translators see."""
    return one_space(protect_terms(gender_words(trimmed(c))))


def after_translation(c: Column) -> Column:
    """Placeholders and wording restored; a trailing gender word moves to the front, a brand stays first."""
    styled = one_space(reduce(lambda x, p: F.regexp_replace(x, *p), STYLE_WORDS, trimmed(c)))
    close = F.regexp_replace(styled, r"(?U)\s+([,./])", "$1")
    front = F.regexp_replace(close, r"(?U)^(.*?)[\s/-]+(男款|女款|儿童款)$", "$2 $1")
    return trimmed(F.regexp_replace(front, r"(?U)^(Montbell)\s+(男款|女款|儿童款)\s+", "$1 $2 "))


def has_kana(c: Column) -> Column:
    return c.rlike(KANA)


def has_han(c: Column) -> Column:
    return c.rlike(HAN)


def range_dashes(markup: Column) -> Column:
    """`W 8 — 10` in text, not in tags, as a span `W 8-10`."""
    number = r"(\d+(?:\.\d+)?)"
    outside = r"(?![^<>]*>)"
    dash = rf"\s*[—–―−ー]\s*{number}{outside}"
    led = F.regexp_replace(markup, rf"\b([A-Za-z]{{1,3}})\s+{number}{dash}", '<span class="range">$1 $2-$3</span>')
    return F.regexp_replace(led, number + dash, '<span class="range">$1-$2</span>')


def code_prefix(code: Column, whole: bool = False) -> Column:
    """The part of a code before its first hyphen, or the whole code."""
    return F.trim(code) if whole else F.split_part(F.trim(code), F.lit("-"), F.lit(1))


def chart_mode(brand: Column) -> Column:
    b = F.upper(F.trim(brand))
    return F.when(b.isin(*LIST_BRANDS), "list").when(b.isin(*RAW_BRANDS), "raw").when(b.isin(*STYLED_BRANDS), "styled").otherwise("table")


def chart_title(brand: Column) -> Column:
    return lookup(TABLE_TITLES, F.upper(F.trim(brand)))


def stock_word(value: Column) -> Column:
    """An availability URL or word as `in-stock` or `out-of-stock`; others stay."""
    v = F.lower(value)
    return F.when(v.endswith("/instock") | (v == "instock"), "in-stock").when(v.endswith("/outofstock") | (v == "outofstock"), "out-of-stock").otherwise(value)


def dot_word(dot: Column) -> Column:
    return F.coalesce(lookup(DOT_WORDS, dot), dot)


def gender_of_name(name: Column) -> Column:
    """男款 unless the name says 女 and nothing of 男."""
    return F.when(name.contains("女") & ~name.contains("男"), "女款").otherwise("男款")
