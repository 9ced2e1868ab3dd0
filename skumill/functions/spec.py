"""Listing specifications: colour words, size words and article numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import HAN, let, nonblank, one_space

#: Size patterns that are cut out of a specification before its colour is read, in this order. Fixed values.
SIZE_PATTERNS = [
    r"(?i)\b(?:SIZE|Size|尺寸|尺码)\s+[A-Za-z0-9\-+/]+(?:[A-Za-z0-9\-+/]+\b)?",
    r"(?i)\b(?:Brand\s+Size|Belt\s+Size|Belt|Brand|Size)\s+\d+[A-Za-z]*",
    r"(?i)\b\d+(?:[A-Za-z\-+/]+\b)?\s+(?:[A-Za-z\x{4e00}-\x{9fff}]+)",
    r"(?i)(?:[A-Za-z\x{4e00}-\x{9fff}]+\s+)?\b\d+[A-Za-z]*\b",
    r"(?i)\bAge\s+\d+\b",
    r"(?i)\b\d+(?:Y|y|岁|\s*Years?\s*Old)?\b",
    r"(?i)\b\d+(?:[A-Za-z]?\-?\d*[A-Za-z]?)?[TtMm]\b",
    r"(?i)\b\d+(?:\-\d+)?[TtMm]\b",
    r"(?i)\b(?:US|JP|UK|EU|FR|IT|DE|ES)\s*\d+\b",
    r"(?i)\b(?:XXXL|XXL|XL|L|M|S|XS|XXS|OS|One\s+Size|均码|OneSize|均号)\b",
    r"(?i)\bOrdered\s+Size\s+[A-Za-z0-9\-/]+\b",
    r"(?i)\bInternational\s+Code\s+[A-Za-z0-9]+\b",
    r"(?i)\b(?:S|M|L|XL|XXL)(?:S|M|L)?\b",
]
#: Size words that are cut out after the patterns. Fixed values.
SIZE_WORDS = ["SIZE", "SIZE:", "BRAND SIZE", "BELT SIZE", "ORDERED SIZE", "均码", "均号", "ONE SIZE", "国际码", "International Code", "Age", "歳", "岁"]
#: Colour codes that stand next to a Han word although they are short. Fixed values.
SHORT_CODES = ("BLK", "WHI", "INBK", "OLGG")
#: Letter sizes that end the scan of a specification. Fixed values.
USUAL_SIZES = ("S", "M", "L", "XS", "XL", "XXS", "XXL", "XXXL")

_OUTER = r"[(（]([^()（）]*)[)）]"
_NESTED = r"[(（][^()（）]*[(（]"


def strip_chars(c: Column, chars: str) -> Column:
    """Without the characters at both ends; `chars` goes into a regex class."""
    return F.regexp_replace(c, rf"^[{chars}]+|[{chars}]+$", "")


def han_run(c: Column, also: str = "x×/") -> Column:
    """The runs of Han characters (and those of `also`) joined: the first colour word."""
    return F.array_join(F.regexp_extract_all(c, F.lit(rf"[\x{{4e00}}-\x{{9fff}}{also}]+"), F.lit(0)), "")


def latin_text(c: Column, keep: str) -> Column:
    """Only the characters of `keep` (a regex class), spaces collapsed, the SZIE typo mended, Mens and Ordered gone."""
    bare = F.trim(F.replace(F.regexp_replace(F.regexp_replace(c, f"[^{keep}]", ""), r"\s+", " "), F.lit("SZIE"), F.lit("SIZE")))
    return F.trim(F.regexp_replace(bare, r"(?i)\b(Mens|Ordered)\b", ""))


def after_keyword(c: Column, keyword: str, token: str) -> Column:
    """The token right after the first `keyword`, without the word One; null if the keyword or token is missing."""
    rest = F.trim(F.regexp_extract(c, rf"(?is)\b{keyword}\b(.*)$", 1))
    return nonblank(F.trim(F.regexp_replace(F.regexp_extract(rest, f"^([{token}]+)", 1), r"(?i)\bOne\b", "")))


def has_keyword(c: Column, keyword: str) -> Column:
    return c.rlike(rf"(?i)\b{keyword}\b")


def without_size(c: Column, keyword: str, size: Column) -> Column:
    """The text without `keyword size` wherever it stands; without a size, the keyword alone goes."""
    cut = F.regexp_replace(c, F.concat(F.lit(rf"(?i){keyword}\s*\Q"), size, F.lit(r"\E")), F.lit(""))
    return F.when(size.isNotNull(), cut).otherwise(F.regexp_replace(c, rf"(?i)\b{keyword}\b", ""))


def ladder(c: Column, steps: Sequence[tuple[str, str]], otherwise: Column) -> Column:
    """struct(size, rest) of the first keyword that the text holds; steps are (keyword, token class).

    The text is read once for each keyword up to the one it holds.
    """

    def read(keyword: str, token: str) -> Column:
        return let(after_keyword(c, keyword, token), lambda own: F.struct(F.coalesce(own, F.lit("")).alias("size"), without_size(c, keyword, own).alias("rest")))

    branches = [(has_keyword(c, keyword), read(keyword, token)) for keyword, token in steps]
    none = F.struct(F.coalesce(otherwise, F.lit("")).alias("size"), F.lit("").alias("rest"))
    found = F.when(*branches[0])
    for branch in branches[1:]:
        found = found.when(*branch)
    return found.otherwise(none)


def color_rest(c: Column) -> Column:
    """The second colour word: without Logo, x 2E, x and One; pure digits are none."""
    left = c
    for word in ("Logo", "x 2E", "x", "One"):
        left = F.replace(left, F.lit(word), F.lit(""))
    left = F.trim(left)
    return F.when(left.rlike(r"^\d+$"), "").otherwise(left)


def _pieces(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda v: F.trim(v)), lambda p: p != "")


def split_brackets(c: Column) -> Column:
    """A size with brackets and slashes as a comma list: what stands outside, then each bracket by its start.

    Brackets of either width pair with each other.  A bracket inside a bracket is
    read by `split_deep_brackets`, at any depth.
    """
    return let(c, lambda text: F.when(text.rlike(_NESTED), split_deep_brackets(text)).when(text.rlike(_OUTER), _split_flat(text)).when(text.contains("/"), F.array_join(_pieces(F.split(text, "/")), ",")).otherwise(text))


def _split_flat(text: Column) -> Column:
    contents = F.transform(F.regexp_extract_all(text, F.lit(_OUTER), F.lit(1)), lambda o: F.trim(o))
    outside = _pieces(F.split(F.trim(F.regexp_replace(text, _OUTER, "")), "/"))
    return F.array_join(F.concat(outside, _bodies(contents)), ",")


def _bodies(contents: Column) -> Column:
    """The contents of brackets, those with slashes in pieces."""
    return F.flatten(F.transform(contents, lambda x: F.when(x.contains("/"), _pieces(F.split(x, "/"))).otherwise(F.array(x))))


def split_deep_brackets(c: Column) -> Column:
    """`split_brackets` for any depth of nesting: one pass over the characters pairs the brackets."""
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.struct(i.alias("i"), F.substring(c, i, F.lit(1)).alias("ch")))
    empty = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast("array<struct<a:int,b:int>>").alias("pairs"))

    def step(state: Column, x: Column) -> Column:
        opens, closes = x["ch"].isin("(", "（"), x["ch"].isin(")", "）") & (F.size(state["open"]) > 0)
        left = F.when(opens, F.array_append(state["open"], x["i"])).when(closes, F.slice(state["open"], F.lit(1), F.size(state["open"]) - 1)).otherwise(state["open"])
        pair = F.struct(F.try_element_at(state["open"], F.lit(-1)).alias("a"), x["i"].alias("b"))
        return F.struct(left.alias("open"), F.when(closes, F.array_append(state["pairs"], pair)).otherwise(state["pairs"]).alias("pairs"))

    def build(pairs: Column) -> Column:
        outside = F.filter(chars, lambda x: ~F.exists(pairs, lambda p: (p["a"] <= x["i"]) & (x["i"] <= p["b"])))
        rest = F.trim(F.array_join(F.transform(outside, lambda x: x["ch"]), ""))
        contents = F.transform(F.array_sort(pairs), lambda p: F.trim(F.substring(c, p["a"] + 1, p["b"] - p["a"] - 1)))
        whole = F.when(c.contains("/"), F.array_join(_pieces(F.split(c, "/")), ",")).otherwise(c)
        return F.when(F.size(pairs) > 0, F.array_join(F.concat(_pieces(F.split(rest, "/")), _bodies(contents)), ",")).otherwise(whole)

    return F.when(c.isNotNull(), let(F.aggregate(chars, empty, step, lambda s: s["pairs"]), build))


def without_size_words(c: Column) -> Column:
    """A specification without anything that reads as a size, and without punctuation at its ends."""
    left = F.trim(F.replace(F.replace(c, F.lit("（"), F.lit("(")), F.lit("）"), F.lit(")")))
    for pattern in SIZE_PATTERNS:
        left = F.regexp_replace(left, "(?U)" + pattern, "")
    for word in SIZE_WORDS:
        left = F.regexp_replace(left, rf"(?iU)\b\Q{word}\E\b", "")
    return F.regexp_replace(one_space(left), r"^[\s\-:;/]+|[\s\-:;/]+$", "")


def color_words(c: Column) -> Column:
    """A colour text as `Han/Latin` where it has both, by slash, hyphen or script; otherwise collapsed."""
    bracket = let(F.regexp_extract(c, r"\((.*?)\)", 1), lambda inner: F.when(c.rlike(r"\(.*?\)") & inner.rlike("[/ -]"), inner).otherwise(c))
    return let(bracket, _color_words)


def _color_words(text: Column) -> Column:
    first = lambda parts, keep: F.get(F.filter(parts, keep), F.lit(0))
    pieces = lambda mark: F.transform(F.split(text, mark), lambda v: F.trim(v))
    both = lambda a, b, pair, other: let(F.struct(a.alias("a"), b.alias("b")), lambda x: F.when(x["a"].isNotNull() & x["b"].isNotNull(), pair(x["a"], x["b"])).otherwise(other))

    def by_slash(parts: Column) -> Column:
        han, latin = first(parts, lambda p: p.rlike(HAN)), first(parts, lambda p: p.rlike("[A-Za-z]") & ~p.rlike(HAN))
        return both(han, latin, lambda a, b: F.concat_ws("/", a, one_space(b)), F.array_join(parts, "/"))

    def by_hyphen(parts: Column) -> Column:
        han, latin = first(parts, lambda p: p.rlike(HAN)), first(parts, lambda p: p.rlike(r"^[A-Za-z\s]+$"))
        return both(han, latin, lambda a, b: F.concat_ws("/", a, b), F.when(F.size(parts) == 2, F.array_join(parts, "/")).otherwise(one_space(text)))

    word, code = F.regexp_extract(text, HAN + "+", 0), F.trim(F.regexp_extract(text, r"[A-Za-z\s]+", 0))
    mixed = let(code, lambda own: F.when((F.length(own) > 1) | own.isin(*SHORT_CODES), F.concat_ws("/", word, own)).otherwise(one_space(text)))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "")
        .when(text.contains("/"), let(pieces("/"), by_slash))
        .when(text.contains("-"), let(pieces("-"), by_hyphen))
        .when(text.rlike(HAN) & text.rlike("[A-Za-z]"), mixed)
        .otherwise(one_space(text))
    )


def first_digits(c: Column) -> Column:
    return nonblank(F.regexp_extract(c, r"\d+", 0))


def first_letters(c: Column) -> Column:
    return nonblank(F.regexp_extract(c, "[a-zA-Z]+", 0))


def before_last_hyphen(c: Column) -> Column:
    """Null without a hyphen."""
    return F.when(c.contains("-"), F.regexp_extract(c, "^(.*)-", 1))


def after_last_hyphen(c: Column) -> Column:
    return F.when(c.contains("-"), F.regexp_extract(c, "-([^-]*)$", 1))


def first_token(c: Column, keep) -> Column:
    """The first space-separated token for which `keep` holds, null without one."""
    return F.get(F.filter(F.split(c, " "), keep), F.lit(0))


def cup_size(c: Column) -> Column:
    """struct(us, jp, raw) of `10.5(29.0cm)`; `S(23.0-25.0)` gives its letters, others stay as they are."""
    letters, numbers = r"^([A-Za-z]+)\(.+?c?m?\)$", r"^(\d+\.?\d*)\((\d+\.?\d*)cm\)$"
    return let(
        F.trim(c),
        lambda text: F.struct(
            nonblank(F.regexp_extract(text, numbers, 1)).alias("us"),
            nonblank(F.regexp_extract(text, numbers, 2)).alias("jp"),
            F.when(text.rlike(letters), F.upper(F.regexp_extract(text, letters, 1))).when(~text.rlike(numbers), text).alias("raw"),
        ),
    )
