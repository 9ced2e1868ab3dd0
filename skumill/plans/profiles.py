"""The brand profiles of the reconciliation: how each reads models, colours and sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sizes as Z
from ..functions import spec as P
from ..functions.price import is_number, size_text
from ..functions.text import gender_of_name, let, nonblank
from ..operators.bind import bound
from ..operators.lookup import match_color
from ..operators.reconcile import Profile

#: Letter sizes that a specification of dotted models may name. Fixed values.
DOTTED_LETTERS = ("S", "M", "L", "XS", "XL", "XXL", "2XL", "XXXL", "3XL", "SS", "LL", "3L", "4L")
#: Words that stand in a specification beside its colour and size, by profile. Fixed values.
SIZE_LIST_NOISE = ("1双装", "1条装", "3双装", "3条装", "套装")
LETTERED_NOISE = ("2只",)
LETTERED_SIZE_NOISE = ("350ml", "500ml", "750ml", "900ml", "/DBN25", "22-24cm", "24-26cm", "26-28cm", "28-30cm", "Hand Circumference")
AGES_NOISE = ("1双装", "两件套", "主页：", "1条装", "均码", "Ordered", "One Size", "Brand ", "Belt ", "（", "）")
SUFFIX_NOISE = ("双装",)
#: Spellings of large sizes as the supply has them, replaced in this order. Fixed values.
LARGE_SIZES = (("XXXXL", "4XL"), ("XXXL", "3XL"), ("2XL", "XXL"))
#: Ages that are written with a T; older ones are months. Fixed values.
TODDLER_AGES = ("2", "3", "4", "5")


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def _text(c: Column) -> Column:
    return _blank(c)


def _spec(df: DataFrame, *drops: str) -> DataFrame:
    c = F.coalesce(F.col("spec"), F.lit(""))
    for d in drops:
        c = F.replace(c, F.lit(d), F.lit(""))
    return bound(df, _spec=F.trim(c))


def _exact(c: Column) -> Column:
    return nonblank(F.trim(c))


def _digits(c: Column) -> Column:
    """A model's digits as a whole number's text: `060421.0` as `60421`."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, r"\.0$", ""), r"0*(\d+)", 1), F.lit(""))


def _want(colors: Column, sizes: Column) -> Column:
    """Every colour with every size."""
    return F.flatten(F.transform(colors, lambda c: F.transform(sizes, lambda s: F.struct(c.alias("color"), s.alias("size")))))


def _only_size(size: Column) -> Column:
    """One want of a size alone; none for a null size."""
    none = F.array().cast("array<struct<color:string,size:string>>")
    return F.when(size.isNotNull(), F.array(F.struct(F.lit("").alias("color"), size.alias("size")))).otherwise(none)


def _list(c: Column) -> Column:
    return F.transform(F.split(c, ","), lambda v: F.trim(v))


def _color_word(article: Column, matched: Column, text: Column, sized: Column) -> Column:
    """The article's own colour; else the matched colour where a size was read, else the bare text; null without one."""
    return F.coalesce(nonblank(_blank(article)), F.when(sized, nonblank(matched)).otherwise(nonblank(_blank(text))))


# --- size list, no colour ----------------------------------------------------


def _size_list(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df = _spec(df, *SIZE_LIST_NOISE)
    df = bound(df, _t=P.latin_text(F.col("_spec"), r"a-zA-Z0-9./（）\-\(\)\s"))
    token = r"a-zA-Z0-9.\-"
    got = P.ladder(F.col("_t"), [("size", r"a-zA-Z0-9./（）\-\(\)"), ("jp", token), ("eu", token)], F.col("_t"))
    df = bound(df, _size=got["size"])
    size = P.split_brackets(F.col("_size"))
    for a, b in LARGE_SIZES:
        size = F.replace(size, F.lit(a), F.lit(b))
    sizes = F.filter(F.transform(_list(F.trim(size)), size_text), lambda s: s != "")
    return bound(df, _sizes=sizes).withColumn("_wants", _want(F.array(F.lit("")), F.col("_sizes")))


# --- article with a colour, three-way match ----------------------------------


def _first_part_digits(c: Column) -> Column:
    return _digits(P.first_digits(F.coalesce(P.before_last_hyphen(c), c)))


def _lettered(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df = _spec(df, *LETTERED_NOISE)
    df = bound(df, _t=P.latin_text(F.col("_spec"), r"a-zA-Z0-9./\-\s"))
    token = r"a-zA-Z0-9.\-"
    got = P.ladder(F.col("_t"), [("size", r"a-zA-Z0-9./\-"), ("jp", token), ("eu", token), ("us", token)], F.col("_t"))
    df, got = bound(df, _got=got), F.col("_got")
    by_us = P.has_keyword(F.col("_t"), "us") & ~F.col("_t").rlike(r"(?i)\b(size|jp|eu)\b")
    size = F.when(by_us & (got["size"] != ""), F.concat(F.lit("US"), got["size"])).when(P.has_keyword(F.col("_t"), "size"), P.strip_chars(got["size"], "/")).otherwise(got["size"])
    for gone in LETTERED_SIZE_NOISE:
        size = F.replace(size, F.lit(gone), F.lit(""))
    df = df.withColumn("_k1", P.strip_chars(P.han_run(F.col("_spec")), "/")).withColumn("_k2", P.strip_chars(F.trim(F.replace(got["rest"], F.lit("-"), F.lit(""))), "/"))
    df = bound(df, _size=size_text(F.trim(size)))
    df = match_color(df, "_k1", "_k2", sheet)
    own = P.first_letters(F.coalesce(P.after_last_hyphen(F.col("article")), F.col("article")))
    color = F.coalesce(own, nonblank(F.col("_matched")), nonblank(_blank(F.col("_t"))))
    return bound(df, _color=F.coalesce(color, F.lit(""))).withColumn("_wants", _want(_list(F.col("_color")), F.array(F.coalesce("_size", F.lit("")))))


def _ages(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df = _spec(df, *AGES_NOISE)
    df = bound(df, _t=F.trim(F.regexp_replace(F.regexp_replace("_spec", r"[^a-zA-Z0-9\-\s]", ""), r"\s+", " ")))
    t, token = F.col("_t"), r"a-zA-Z0-9\-"
    worded = t.rlike(r"(?i)\b(size|us|age)\b")
    letters = let(F.filter(F.split(t, r"\s+"), lambda p: p.isin(*P.USUAL_SIZES)), lambda found: F.get(found, F.size(found) - 1))
    df, letters = bound(df, _letters=letters), F.col("_letters")
    got = P.ladder(t, [("size", token), ("us", token), ("age", token)], F.coalesce(letters, F.lit("")))
    df, got = bound(df, _got=got), F.col("_got")
    by_age = P.has_keyword(t, "age") & ~t.rlike(r"(?i)\b(size|us)\b")
    size = F.when(by_age & (got["size"] != ""), F.concat(got["size"], F.when(got["size"].isin(*TODDLER_AGES), "T").otherwise("M"))).otherwise(got["size"])
    bare = F.coalesce(nonblank(F.trim(F.regexp_replace(t, F.concat(F.lit(r"(?i)\b\Q"), letters, F.lit(r"\E\b")), F.lit("")))), t)
    df = df.withColumn("_k2", F.when(worded, P.strip_chars(F.trim(got["rest"]), r"\-")).otherwise(bare))
    read = P.color_words(P.without_size_words(F.col("_spec")))
    df = bound(df, _k1=F.coalesce(nonblank(read), P.han_run(F.col("_spec"), "")), _size=size_text(size))
    df = match_color(df, "_k1", "_k2", sheet)
    color = _color_word(P.first_letters(F.col("article")), F.col("_matched"), t, F.col("_size") != "")
    return df.withColumn("_wants", F.array(F.struct(color.alias("color"), F.col("_size").alias("size"))))


def _suffix_model(c: Column) -> Column:
    return nonblank(F.coalesce(P.before_last_hyphen(c), F.regexp_extract(c, "[a-zA-Z0-9]+", 0)))


def _suffix(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df = _spec(df, *SUFFIX_NOISE)
    df = bound(df, _t=P.latin_text(F.col("_spec"), r"a-zA-Z0-9.\-\s"))
    t, token = F.col("_t"), r"a-zA-Z0-9.\-"
    df, got = bound(df, _got=P.ladder(t, [("size", token), ("jp", token), ("eu", token)], t)), F.col("_got")
    by_eu = P.has_keyword(t, "eu") & ~t.rlike(r"(?i)\b(size|jp)\b")
    size = F.when(by_eu & (got["size"] != ""), F.coalesce(Z.two_chart_sizes(got["size"]), F.lit("尺码未找到"))).otherwise(got["size"])
    df = df.withColumn("_k1", F.trim(P.strip_chars(F.replace(P.han_run(F.col("_spec")), F.lit("宽"), F.lit("")), "/"))).withColumn("_k2", P.color_rest(F.replace(got["rest"], F.lit("-"), F.lit(""))))
    df = bound(df, _size=size)
    df = match_color(df, "_k1", "_k2", sheet)
    code = nonblank(F.regexp_extract(P.after_last_hyphen(F.col("article")), "[a-zA-Z0-9]+", 0))
    color = _color_word(F.when(~code.rlike(r"^\d+$"), code), F.col("_matched"), t, F.col("_size") != "")
    sizes = F.transform(_list(F.col("_size")), lambda s: F.replace(s, F.lit(".0"), F.lit("")))
    df = bound(df, _color=F.coalesce(color, F.lit("")), _sizes=sizes)
    return df.withColumn("_wants", _want(_list(F.col("_color")), F.col("_sizes")))


# --- sizes alone -------------------------------------------------------------


def _dotted_model(c: Column) -> Column:
    """Hyphens as dots; without one, a dot after the eighth character."""
    dotted = F.replace(F.upper(_exact(c)), F.lit("-"), F.lit("."))
    return let(dotted, lambda d: F.when(d.contains("."), d).otherwise(F.concat(F.substring(d, F.lit(1), F.lit(8)), F.lit("."), F.substring(d, F.lit(9), F.length(d)))))


def _dotted(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df = _spec(df)
    scale = P.first_token(F.col("_spec"), lambda x: x.isin("JP", "EU"))
    size = P.first_token(F.col("_spec"), lambda x: is_number(x) | x.isin(*DOTTED_LETTERS))
    df, size = bound(df, _first=size), F.col("_first")
    read = F.when(F.col("_spec").contains("双装"), Z.sock_size(size)).when(scale == "JP", size).otherwise(Z.eu_or_letter(size))
    return bound(df, _size=size_text(read)).withColumn("_wants", _only_size(F.col("_size")))


def _canvas(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df, c = _spec(df), F.col("_spec")
    n = r"([0-9]+\.?[0-9]*)"
    letters, both = F.upper(F.regexp_extract(c, r"(?i)SIZE\s*([SMLXO]+)", 1)), rf"(?i)JP\s*{n}[^0-9]*\(EU\s*{n}"
    jp = nonblank(F.coalesce(nonblank(F.regexp_extract(c, both, 1)), F.regexp_extract(c, rf"(?i)JP\s*{n}", 1)))
    df, letters, jp = bound(df, _letters=letters, _jp=jp), F.col("_letters"), F.col("_jp")
    eu = F.when(jp.isNotNull(), nonblank(F.regexp_extract(c, both, 2))).otherwise(nonblank(F.regexp_extract(c, rf"(?i)EU\s*{n}", 1)))
    df, eu = bound(df, _eu=eu), F.col("_eu")
    span = F.replace(F.regexp_extract(c, r"([0-9]+\.?[0-9]*\s*-\s*[0-9]+\.?[0-9]*)", 1), F.lit(" "), F.lit(""))
    read = (
        F.when(letters != "", letters)
        .when(jp == "24.5", size_text(eu))
        .when(jp.isNotNull(), size_text(jp))
        .when(eu.isin("38", "39"), eu)
        .when(eu.isNotNull(), Z.canvas_size(eu))
        .when(span != "", span)
        .otherwise("ONE")
    )
    return bound(df, _size=read).withColumn("_wants", _only_size(F.col("_size")))


def _canvas_supply(c: Column) -> Column:
    read = lambda got: F.when((got["jp"] == "24.5") & (got["us"] == "5.5"), "38").when(got["jp"] == "24.5", "39").when(got["jp"].isNotNull(), size_text(got["jp"])).otherwise(got["raw"])
    return let(P.cup_size(F.coalesce(c.cast("string"), F.lit(""))), read)


def _outdoor(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    tokens = F.split(F.regexp_replace(F.coalesce(F.col("spec"), F.lit("")), r"\([^)]*\)", ""), " ")
    df = bound(df, _tokens=tokens)
    df = bound(df, _scale=F.get(F.filter("_tokens", lambda x: x.isin("JP", "EU", "US", "UK")), F.lit(0)))
    read = F.transform("_tokens", lambda x: Z.outdoor_size(x, F.col("product_name"), F.col("_scale")))
    df = bound(df, _size=size_text(F.get(F.filter(read, lambda x: x.isNotNull()), F.lit(0))))
    return df.withColumn("_wants", _only_size(F.col("_size")))


def _gendered(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    df, c = _spec(df), F.col("_spec")

    def last(pattern: str) -> Column:
        return let(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda every: F.get(every, F.size(every) - 1))

    jp, eu = last(r"(?i)JP\s*(\d+(?:\.\d+)?)"), last(r"(?i)EU\s*(\d+(?:\.\d+)?)")
    kids, letter = last(r"(?i)SIZE\s*(\d+)"), last(r"(?i)\b(S|M|L|XL|XXL|XS)\b")
    df = bound(df, _jp=jp, _eu=eu, _kids=kids, _letter=letter)
    jp, eu, kids, letter = (F.col(x) for x in ("_jp", "_eu", "_kids", "_letter"))
    by_eu = F.coalesce(Z.gendered_size(eu, gender_of_name(F.coalesce(F.col("product_name"), F.lit("")))), F.lit("EU not found"))
    read = F.when(jp.isNotNull(), size_text(jp)).when(eu.isNotNull(), by_eu).when(kids.isNotNull(), size_text(kids)).when(letter.isNotNull(), F.upper(letter)).otherwise("ONE SIZE")
    return bound(df, _size=read).withColumn("_wants", _only_size(F.col("_size")))


def _size_supply(c: Column) -> Column:
    return F.coalesce(size_text(c), F.lit(""))


def _plain(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    """`<colour> SIZE <size>`, either part may be blank."""
    text = F.coalesce(F.col("spec"), F.lit(""))
    color, size = F.trim(F.regexp_extract(text, r"(?i)^(.*?)\bSIZE\b", 1)), F.trim(F.regexp_extract(text, r"(?i)\bSIZE\b(.*)$", 1))
    return df.withColumn("_wants", F.array(F.struct(color.alias("color"), F.coalesce(size_text(size), F.lit("")).alias("size"))))


PROFILES: dict[str, Profile] = {
    "plain_spec": Profile(_exact, _exact, _plain, _text, _size_supply, single=True),
    "size_list": Profile(_exact, _exact, _size_list, supply_size=_size_supply),
    "lettered_article": Profile(_first_part_digits, _digits, _lettered, _text, _size_supply),
    "colour_in_word": Profile(lambda c: _digits(P.first_digits(c)), _digits, _ages, _text, _size_supply, contains=True, multiplier=1.2),
    "suffix_article": Profile(_suffix_model, _exact, _suffix, _text, lambda c: F.replace(_text(c), F.lit(".0"), F.lit("")), multiplier=1.2),
    "dotted_model": Profile(_dotted_model, _exact, _dotted, supply_size=_size_supply, compare_discounted=True, single=True, tolerant=True),
    "canvas_sizes": Profile(_exact, _exact, _canvas, supply_size=_canvas_supply, single=True),
    "outdoor_sizes": Profile(lambda c: _digits(F.regexp_replace(c, r"\D", "")), _digits, _outdoor, supply_size=_size_supply, single=True, tolerant=True),
    "gendered_sizes": Profile(_exact, _exact, _gendered, supply_size=_size_supply, single=True),
    "model_only": Profile(_exact, _exact, lambda df, sheet: df.withColumn("_wants", _only_size(F.lit(""))), margin_only=True, single=True),
}


def profile(name: str) -> Profile:
    """A profile by name; a KeyError names the known ones."""
    if name not in PROFILES:
        raise KeyError(f"{name}: known profiles are {', '.join(PROFILES)}")
    return PROFILES[name]
