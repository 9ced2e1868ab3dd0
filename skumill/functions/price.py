"""Prices, costs, stock numbers and numeric sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract, nonblank

#: (upper cost bound, added amount, divisor) of the bid tiers; the first bound is exclusive. Fixed values.
BID_TIERS = [(11500, 2600.0, 0.99), (78500, 1900.0, 0.94), (None, 5930.0, 0.99)]
#: Quantity by stock word. Fixed values.
QUANTITIES = {"in-stock": "6", "low-stock": "3", "out-of-stock": "0"}
TAX = 1.1
#: Markup of a product page's price, as patterns in order. Fixed values.
PRICE_MARKUP = (r'itemprop="price"[^>]*content="([\d.,]+)"', r'class="value"[^>]*content="([\d.,]+)"')
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column) -> Column:
    """A text as double, null where it is none; letters that only a JVM takes for a number are none."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def is_number(c: Column) -> Column:
    """False for null; the words nan and inf count as numbers."""
    return F.coalesce(c.cast("string").rlike(_NUMBER) | F.lower(F.trim(c.cast("string"))).rlike("^[+-]?(nan|inf|infinity)$"), F.lit(False))


def usable(c: Column) -> Column:
    """A price as double; null for null, '', '-', NaN and text."""
    value = number(c)
    return F.when(~F.isnan(value), value)


def plain_text(c: Column) -> Column:
    """A column as text, a number without an exponent: 1.2345678E7 as 12345678.0."""
    wide = F.regexp_replace(c.try_cast("decimal(38,12)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.typeof(c).isin("double", "float") & c.cast("string").contains("E"), F.coalesce(wide, c.cast("string"))).otherwise(c.cast("string"))


def price_text(c: Column) -> Column:
    """The first digit group of a price as a text of digits, '' without one; a number loses what is behind its point."""
    return F.coalesce(F.replace(F.regexp_extract(plain_text(c), r"(?:¥|￥)?\s*([\d,]+)", 1), F.lit(",")), F.lit(""))


def price_of_json(text: Column, path: str = "$") -> Column:
    """A price object's first usable key: displayRegularPrice, displayPrice, price, value; a plain value counts too."""
    keys = [price_text(F.get_json_object(text, f"{path}.{k}")) for k in ("displayRegularPrice", "displayPrice", "price", "value")]
    return F.coalesce(*map(nonblank, keys), F.when(~F.get_json_object(text, path).startswith("{"), price_text(F.get_json_object(text, path))), F.lit(""))


def yen(c: Column) -> Column:
    """`12320.5` as `¥ 12,320`; null and '' give '', text passes through."""
    value = number(c)
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    return F.when(c.isNull() | (c.cast("string") == ""), "").when(value.isNull(), c.cast("string")).otherwise(F.concat(F.lit("¥ "), F.format_number(whole, 0)))


def with_tax(c: Column) -> Column:
    """10 % added, rounded half to even, as text; what is not a number passes through."""
    value = number(c)
    return F.when(value.isNull(), c.cast("string")).otherwise(F.bround(value * F.lit(TAX), 0).cast("bigint").cast("string"))


def bid_price(cost: Column, multiplier: float = 1.15, mode: str = "ceil") -> Column:
    """(multiplier x cost + amount) / divisor of the cost's tier, to whole hundreds."""
    if mode not in ("ceil", "round"):
        raise ValueError("mode is 'ceil' or 'round'")
    c = cost.cast("double")
    raw = [(F.lit(multiplier) * c + F.lit(add)) / F.lit(div) for _, add, div in BID_TIERS]
    price = F.when(c < BID_TIERS[0][0], raw[0]).when(c <= BID_TIERS[1][0], raw[1]).otherwise(raw[2]) / F.lit(100.0)
    return F.when(c.isNotNull(), (F.ceil(price) if mode == "ceil" else F.bround(price, 0).cast("bigint")) * 100)


def supply_bid(discounted: Column, msrp: Column, multiplier: float = 1.15) -> Column:
    """The bid for the discounted price where it is usable, else for the msrp."""
    return bid_price(F.coalesce(usable(discounted), usable(msrp)), multiplier)


def differing(sale: Column, listed: Column) -> Column:
    """The sale price where there is one that differs from the list price, else ''."""
    return F.when((sale != "") & ((sale != listed) | listed.isNull()), sale).otherwise("")


def page_price(html: Column) -> Column:
    """The price of a product page by two patterns in order, without commas; '' without one."""
    return F.coalesce(F.replace(F.coalesce(*[extract(html, p) for p in PRICE_MARKUP]), F.lit(",")), F.lit(""))


def first_yen(text: Column) -> Column:
    """The first yen amount of a text with a half-width sign, null without one."""
    return F.replace(nonblank(F.regexp_extract(text, r"[¥￥]\s*[0-9][0-9,]*(?:\.\d+)?", 0)), F.lit("￥"), F.lit("¥"))


def displayed_price(html: Column, selector: str) -> Column:
    """The content attribute of a buy box's .value under `sales` or `list`, as a whole number; invalid gives null."""
    box = F.regexp_extract(html, r'(?s)class="[^"]*buy-config-price[^"]*"(.*)$', 1)
    raw = F.regexp_extract(box, rf'(?s)class="[^"]*\b{selector}\b[^"]*"[^>]*>.*?class="[^"]*\bvalue\b[^"]*"[^>]*content="([^"]*)"', 1)
    return F.floor(number(raw)).cast("bigint")


def stock_quantity(status: Column) -> Column:
    """6, 3 or 0 by stock word, '' for others."""
    word = F.lower(F.trim(status))
    return F.coalesce(F.when(word == "in-stock", QUANTITIES["in-stock"]).when(word == "low-stock", QUANTITIES["low-stock"]).when(word == "out-of-stock", QUANTITIES["out-of-stock"]), F.lit(""))


def live_quantity(in_stock: Column, available: Column, cap: int = 5) -> Column:
    """Available stock within 0 and the cap (none if not positive); 1 where only the flag is known."""
    known = F.least(available, F.lit(cap)) if cap > 0 else available
    return F.when(F.coalesce(in_stock, F.lit(False)), F.when(available.isNull(), 1).otherwise(F.greatest(F.lit(0), known))).otherwise(0).cast("int")


def size_text(c: Column) -> Column:
    """`24.0` as `24`, `024.50` as `24.5`; anything but plain digits with a point stays, trimmed."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"^(\d+)\.0*$", "$1")
    text = F.regexp_replace(text, r"^(\d+\.\d*[1-9])0+$", "$1")
    return F.regexp_replace(text, r"^\+?0+(?=\d+(?:\.\d+)?$)", "")


def cost_number(c: Column) -> Column:
    """A cost text without spaces and commas, rounded half to even; null where it is no number."""
    return F.bround(usable(F.regexp_replace(c.cast("string"), "[ ,]", "")), 0)


def close_to(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Equal within a relative or absolute tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))
