"""URLs, hashes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, nonblank, one_space

IMAGE_NAME = r"\.(jpg|jpeg|png|gif|webp)$"


def plain_url(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit("&amp;"), F.lit("&")))


def scheme_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def absolute(link: Column, base: Column) -> Column:
    """A link resolved against the URL of its page; `.` segments go and `..` segments climb, up to four in a row."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.coalesce(nonblank(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)[^/?#]*(?:[?#].*)?$", 1)), F.concat(origin, F.lit("/")))
    folder = F.when(folder.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://$"), F.concat(origin, F.lit("/"))).otherwise(folder)
    joined = (
        F.when(link.startswith("//"), F.concat(scheme_of(base), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link == "", base)
        .when(link.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .otherwise(F.concat(folder, link))
    )
    # /./ and x/../ before any query
    flat = F.regexp_replace(joined, r"(?<=/)(?:\./)+", "")
    for _ in range(4):
        flat = F.regexp_replace(flat, r"^([^?#]*[^/?#])/(?!\.\.?/)[^/?#]+/\.\./", "$1/")
    flat = F.regexp_replace(flat, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(?:/\.\.)+/", "$1/")
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.contains("./"), flat).otherwise(joined)


def signature(values: Column, length: int, separator: str = "\n", ordered: bool = True) -> Column:
    """The first hex digits of the md5 of a list; ordered=False sorts it first."""
    return F.substring(F.md5(F.array_join(values if ordered else F.sort_array(values), separator).cast("binary")), 1, length)


def canonical_product(url: Column, base: str | Column) -> Column:
    """Absolute, with only its colour parameters (dwvar_*_color) and no fragment."""
    whole = absolute(F.replace(url, F.lit("&amp;"), F.lit("&")), F.lit(base) if isinstance(base, str) else base)
    kept = F.filter(F.split(query_of(whole), "&"), lambda p: p.rlike(r"^dwvar_[^=]*_color(=|$)"))
    return F.concat(F.regexp_replace(whole, r"[?#].*$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&"))).otherwise(""))


def model_of(url: Column) -> Column:
    """The digits before .html, '' without them."""
    return F.regexp_extract(url, r"/(\d+)\.html(?:$|[?#])", 1)


def prod_model_of(url: Column) -> Column:
    return F.regexp_extract(url, r"/(prod[0-9A-Za-z]+)\.html", 1)


def color_of(url: Column, model: Column | None = None) -> Column:
    """The colour that a URL selects: its model's own parameter or selectedColor, else the first dwvar_*_color; '' without one."""
    pairs = F.split(query_of(F.replace(url, F.lit("&amp;"), F.lit("&"))), "&")
    own = prod_model_of(url) if model is None else model
    wanted = F.concat(F.lit("dwvar_"), own, F.lit("_color="))

    def rank(p: Column, i: Column) -> Column:
        named = p.startswith("selectedColor=") | ((own != "") & p.startswith(wanted))
        order = F.when(~p.rlike("=."), 2).when(named, 0).when(p.rlike("^[^=]*_color="), 1).otherwise(2)
        return F.struct(order.alias("o"), i.alias("i"), p.alias("p"))

    best = F.array_min(F.filter(F.transform(pairs, rank), lambda x: x["o"] < 2))
    return F.coalesce(one_space(F.try_url_decode(F.regexp_replace(best["p"], "^[^=]*=", ""))), F.lit(""))


def category_of(url: Column) -> Column:
    """The path segment after /c/, in lower case."""
    return F.lower(F.regexp_extract(path_of(url), r"(?:^|/)c/([^/]+)", 1))


def clean_image(url: Column, host: str) -> Column:
    """An image of `host` with its resize parameters gone and only sfrm kept (png without one); others are trimmed."""
    raw = F.trim(F.replace(url, F.lit("&amp;"), F.lit("&")))
    form = F.coalesce(nonblank(F.regexp_extract(query_of(raw), r"(?:^|&)sfrm=([^&]*)", 1)), F.lit("png"))
    return F.when(F.coalesce(raw, F.lit("")) == "", "").when(host_of(raw).contains(host), F.concat(F.regexp_replace(raw, r"[?#].*$", ""), F.lit("?sfrm="), form)).otherwise(raw)


def file_name(url: Column) -> Column:
    return F.element_at(F.split(path_of(url), "/"), -1)


def variant_url(url: Column, model: Column, color: Column, upc: Column, base: str) -> Column:
    """The URL with a UPC of ten digits or more as its page, else with its colour as the only dwvar parameter; without a colour the canonical URL."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", "")
    kept = F.filter(F.split(query_of(url), "&"), lambda p: (p != "") & ~F.lower(p).startswith("dwvar_"))
    query = F.array_join(F.array_append(kept, F.concat(F.lit("dwvar_"), model, F.lit("_color="), F.url_encode(color))), "&")
    return (
        F.when(F.coalesce(color, F.lit("")) == "", canonical_product(url, base))
        .when(upc.rlike(r"^\d{10,}$"), F.concat(F.regexp_replace(path, r"[^/]*$", ""), upc, F.lit(".html")))
        .otherwise(F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit("?"), query))
    )


def search_url(site: str, text: Column) -> Column:
    return F.concat(F.lit(site + "/search?q="), F.url_encode(text))


def variation_url(endpoint: Column, model: Column, color: Column, size: Column) -> Column:
    """The lookup of one variant's stock and price; a blank size is left out."""
    part = F.concat(F.lit("&dwvar_"), model, F.lit("_size="), size)
    return F.concat(endpoint, F.lit("?pid="), model, F.lit("&dwvar_"), model, F.lit("_color="), color, F.when(F.coalesce(size, F.lit("")) != "", part).otherwise(""), F.lit("&quantity=1"))


def versioned(base: str, key: Column, content_hash: Column) -> Column:
    """base/key with the hash's first 12 characters as its version, if there is a hash."""
    url = F.concat(F.lit(base + "/"), key)
    return F.when(F.coalesce(content_hash, F.lit("")) != "", F.concat(url, F.lit("?v="), F.substring(content_hash, 1, 12))).otherwise(url)


def unversioned(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def content_hash(content: Column) -> Column:
    return F.md5(content)


def safe_name(name: Column) -> Column:
    """Characters that a file name may not have as underscores."""
    return F.trim(F.translate(name, '<>:"/\\|?*', "_________"))


def object_key(brand: Column, model: Column, url: Column, position: Column) -> Column:
    """brand/model/file; a URL without an image name gives image_<position>.jpg."""
    name = F.split_part(F.element_at(F.split(url, "/"), -1), F.lit("?"), F.lit(1))
    named = F.when(F.lower(name).rlike(IMAGE_NAME), name).otherwise(F.concat(F.lit("image_"), position.cast("string"), F.lit(".jpg")))
    return F.concat_ws("/", safe_name(brand), safe_name(model), safe_name(named))


def decoded(c: Column) -> Column:
    """URL-decoded and cleaned; a plus sign stays one."""
    return clean_text(F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c))
