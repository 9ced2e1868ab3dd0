"""Reconciliation of a listing table with a supply table.

A listing takes the first supply row, by position, of its model whose colour and
size fit.  Both sides are brought to equal keys, so the match is a hash join: the
supply is first reduced to the earliest row of each (model, colour, size), and a
listing with several possible colours or sizes asks once for each of them.
Listings that agree in all that is read of them are read and matched once.  A
popular model therefore never meets a popular model pair by pair.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.price import bid_price, cost_number, number, plain_text, supply_bid, usable
from ..functions.sizes import same_size
from ..functions.text import let
from .bind import bound

#: The columns of a listing that profiles read.
READ = ("article", "spec", "product_name")
#: Width of a range of numbers in a tolerant join, and how far a number reaches beyond its own.
RANGE, SLACK = 1e-6, 1.01e-9


@dataclass(frozen=True)
class Profile:
    """How one brand's listings are read.

    listing_model, supply_model: model keys (null: no model).
    wants: adds `_wants`, array<struct<color, size>>, to a listing; the second argument is the colour sheet.
    supply_color, supply_size: the supply's keys, '' where it has none.
    contains: a wanted colour need only hold the supply's colour (`_wants` has one entry; a null colour wants a blank one).
    single: a listing wants one colour and size at most, so it joins the supply directly.
    compare_discounted: the discounted price, where there is one, is compared with the cost.
    margin_only: the cost becomes the discounted price and only the margin is judged.
    tolerant: sizes that are numbers fit within 1e-9 (relative above 1, absolute below); others as texts.
    """

    listing_model: Callable[[Column], Column]
    supply_model: Callable[[Column], Column]
    wants: Callable[[DataFrame, DataFrame | None], DataFrame]
    supply_color: Callable[[Column], Column] = lambda c: F.lit("")
    supply_size: Callable[[Column], Column] = lambda c: F.lit("")
    contains: bool = False
    single: bool = False
    multiplier: float = 1.15
    compare_discounted: bool = False
    margin_only: bool = False
    tolerant: bool = False


def _earliest(supply: DataFrame, profile: Profile) -> DataFrame:
    """The first supply row, by position, of each (model, colour, size); rows that are written alike are read once."""
    written = [F.col(c).cast("string").alias(c) for c in ("model", "color", "size")]
    rows = supply.select(*written, F.struct("pos", "msrp", "discounted_price", "quantity").alias("supply"))
    alike = rows.groupBy("model", "color", "size").agg(F.min_by("supply", "supply.pos").alias("supply"))
    keyed = bound(alike, _model=F.upper(profile.supply_model(F.col("model"))), _color=profile.supply_color(F.col("color")), _size=profile.supply_size(F.col("size")))
    return keyed.where("_model is not null and _size is not null").groupBy("_model", "_color", "_size").agg(F.min_by("supply", "supply.pos").alias("supply"))


def _text(listing: DataFrame) -> Column:
    """What a profile reads of a listing, as one value; nulls in it are equal."""
    return F.struct(*[c for c in READ if c in listing.columns])


def _asked(listing: DataFrame, profile: Profile, sheet: DataFrame | None, **carried: Column) -> DataFrame:
    """(_text, _model) of each distinct text and its wants, or for a profile of single wants its colour and size.

    Listings repeat their texts, and reading one is the costly step, so each is read
    once; the model is bound, or a filter on it would read that of every listing.
    `carried` are aggregates over the listings of a text.
    """
    read = [c for c in READ if c in listing.columns]
    texts = listing.groupBy(*read).agg(*[c.alias(n) for n, c in carried.items()]) if carried else listing.select(*read).distinct()
    rows = profile.wants(texts.withColumn("_text", _text(listing)), sheet)
    model = F.upper(profile.listing_model(F.col("article")))
    if profile.single:
        rows = bound(rows, _model=model, _want=F.get("_wants", F.lit(0)))
        return rows.select(*carried, "_text", "_model", F.col("_want.color").alias("_color"), F.col("_want.size").alias("_size"))
    return bound(rows, _model=model).select(*carried, "_text", "_model", "_wants")


def _size_keys(size: Column, slack: float) -> Column:
    """The keys of a size: the ranges of numbers that lie within `slack` of it, else the text itself.

    Numbers are laid out so that a tolerance of 1e-9, relative above 1, is a distance
    of 1e-9 everywhere; a range is a millionth wide.  A number within the slack of a
    bound has two ranges.
    """

    def ranges(x: Column) -> Column:
        far = F.signum(x) * F.when(F.abs(x) <= 1, F.abs(x)).otherwise(1 + F.ln(F.abs(x)))
        return F.array_distinct(F.transform(F.array(F.lit(-slack), F.lit(slack)), lambda d: F.concat(F.lit("n"), F.floor((far + d) / RANGE).cast("string"))))

    finite = number(size)
    return F.when(F.abs(finite) < float("inf"), let(finite, ranges)).otherwise(F.array(F.concat(F.lit("t"), size)))


def _own(asks: DataFrame) -> list[str]:
    return [c for c in asks.columns if c not in ("_model", "_color", "_want", "_wants", "_size")]


def _close_in_size(asks: DataFrame, firsts: DataFrame) -> DataFrame:
    """The asking row's own columns and supply of all pairs of one model and colour whose sizes fit within 1e-9: a hash join on ranges, checked exactly."""
    asked = asks.withColumn("_key", F.explode(_size_keys(F.col("_size"), SLACK)))
    given = firsts.withColumnRenamed("_size", "_given").withColumn("_key", F.explode(_size_keys(F.col("_given"), 0.0)))
    return asked.join(given, ["_model", "_color", "_key"]).where(same_size(F.col("_size"), F.col("_given"))).select(*_own(asks), "supply")


def _holding_colors(asks: DataFrame, firsts: DataFrame) -> DataFrame:
    """The asking row's own columns and supply of all pairs of one model and size where the wanted word holds the supply's colour; a null word holds only a blank one.

    A word asks once for each of its pieces that is as long as a colour of its model,
    so this is a hash join on equal colours.
    """
    lengths = firsts.groupBy("_model").agg(F.collect_set(F.length("_color")).alias("_lengths"))
    piece = lambda word, n: F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n))
    pieces = F.flatten(F.transform(F.filter("_lengths", lambda n: n <= F.length("_want")), lambda n: F.when(n == 0, F.array(F.lit(""))).otherwise(piece(F.col("_want"), n))))
    asked = asks.join(lengths, "_model").select(*_own(asks), "_model", "_size", F.explode(F.when(F.col("_want").isNull(), F.array(F.lit(""))).otherwise(F.array_distinct(pieces))).alias("_color"))
    return asked.join(firsts, ["_model", "_color", "_size"]).select(*_own(asks), "supply")


def _first_of_texts(asks: DataFrame, supply: DataFrame, profile: Profile) -> DataFrame:
    """_text, what `_asked` carries and supply: the first fitting supply row of each text of `_asked` that has one."""
    own = _own(asks)
    asks, firsts = asks.where("_model is not null"), _earliest(supply, profile)
    if profile.single and not profile.tolerant:
        return asks.join(firsts, ["_model", "_color", "_size"]).select(*own, "supply")
    if profile.tolerant and profile.single:
        pairs = _close_in_size(asks, firsts)
    else:
        asks = asks.select(*own, "_model", F.explode("_wants").alias("_w"))
        asks = asks.select(*own, "_model", F.col("_w.size").alias("_size"), F.col("_w.color").alias("_want"))
        if profile.contains:
            pairs = _holding_colors(asks, firsts)
        else:
            asks = asks.withColumnRenamed("_want", "_color")
            pairs = _close_in_size(asks, firsts) if profile.tolerant else asks.join(firsts, ["_model", "_color", "_size"])
    return pairs.groupBy(*own).agg(F.min_by("supply", "supply.pos").alias("supply"))


def first_match(listing: DataFrame, supply: DataFrame, profile: Profile, sheet: DataFrame | None = None) -> DataFrame:
    """(pos, sku_id, supply): the first fitting supply row of each listing that has one."""
    found = _first_of_texts(_asked(listing, profile, sheet), supply, profile)
    return listing.select("pos", "sku_id", _text(listing).alias("_text")).join(found, "_text").select("pos", "sku_id", "supply")


def _models(df: DataFrame, name: str, model: Callable[[Column], Column]) -> DataFrame:
    """The models of a column; each distinct value is read once, and not again where a filter asks for it."""
    values = df.select(F.col(name).cast("string").alias(name)).distinct()
    return bound(values, _model=F.upper(model(F.col(name)))).select("_model").where("_model is not null").distinct().withColumn("_known", F.lit(True))


def _joined_status(*parts: Column) -> Column:
    return F.concat_ws("\n", *[F.nullif(p, F.lit("")) for p in parts])


def reconcile_listing(listing: DataFrame, supply: DataFrame, profile: Profile, sheet: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """`listing` with status, new_lead_time, new_bid, new_stock, cost (corrected), old_cost and bid_price.

    A listing's computed columns that are there already are replaced.  A null
    article is no model; a null spec counts as blank.
    """
    made = ["status", "new_lead_time", "new_bid", "new_stock", "old_cost", "bid_price"]
    rows = listing.drop(*made)
    known = _models(supply, "model", profile.supply_model)
    if matches is None:
        asks = _asked(rows, profile, sheet)
        texts = asks.select("_text", "_model").join(_first_of_texts(asks, supply, profile), "_text", "left").join(known, "_model", "left").drop("_model")
        rows = rows.withColumn("_text", _text(rows)).join(texts, "_text", "left")
    else:
        rows = rows.withColumn("_model", F.upper(profile.listing_model(F.col("article")))).join(matches.select("pos", "supply"), "pos", "left")
        rows = rows.join(known, "_model", "left")
    s = F.col("supply")
    hit = s.isNotNull()
    # one step a projection: each is used several times below
    rows = rows.withColumn("_msrp", F.bround(usable(s["msrp"]), 0)).withColumn("_old", cost_number(F.col("cost")))
    if profile.margin_only:
        price = usable(s["discounted_price"])
        note = F.when(price >= cost_number(F.col("expected_income")), F.concat(F.lit(S.MARGIN), plain_text(price)))
        rows = rows.withColumn("_cost", price).withColumn("_changed", F.lit(None).cast("double")).withColumn("_note", note)
    else:
        against = F.coalesce(F.bround(usable(s["discounted_price"]), 0), F.col("_msrp")) if profile.compare_discounted else F.col("_msrp")
        rows = rows.withColumn("_differs", hit & (F.col("_old").isNull() | (against != F.col("_old"))))
        rows = rows.withColumn("_cost", F.when(F.col("_differs"), F.col("_msrp")).otherwise(F.col("_old")))
        rows = rows.withColumn("_changed", F.when(F.col("_differs"), F.col("_old"))).withColumn("_note", F.when(F.col("_differs"), S.COST_CHANGED))
    out_of_stock = F.when(s["quantity"] == 0, S.NO_STOCK)
    status = F.when(F.col("_known").isNull(), S.NO_MODEL).when(~hit, S.NO_SPEC).otherwise(_joined_status(F.col("_note"), out_of_stock))
    bid = F.lit(None).cast("bigint") if profile.margin_only else bid_price(F.col("_cost"), profile.multiplier)
    return rows.select(
        *[F.col(c) for c in listing.columns if c not in (*made, "cost")],
        F.when(hit, plain_text(F.col("_cost"))).otherwise(plain_text(F.col("cost"))).alias("cost"),
        status.alias("status"),
        F.when(hit, F.col("lead_time")).alias("new_lead_time"),
        F.when(hit, F.col("my_bid")).alias("new_bid"),
        F.when(hit, s["quantity"]).alias("new_stock"),
        F.when(hit, F.col("_changed")).cast("bigint").alias("old_cost"),
        F.when(hit, bid).alias("bid_price"),
    )


def reconcile_supply(listing: DataFrame, supply: DataFrame, profile: Profile, sheet: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """`supply` with status, bid_price and the sku_id of the last listing that took it.

    Listings of one text take the same row, so the last of each text stands for them.
    """
    rows = supply.drop("status", "bid_price", "sku_id")
    if matches is None:
        last = _asked(listing, profile, sheet, sku_id=F.max_by("sku_id", "pos"), pos=F.max("pos"))
        matches = _first_of_texts(last, supply, profile)
    taken = matches.groupBy(F.col("supply.pos").alias("pos")).agg(F.max_by("sku_id", "pos").alias("sku_id"), F.count("*").alias("_taken"))
    known = _models(listing, "article", profile.listing_model)
    rows = rows.withColumn("_model", F.upper(profile.supply_model(F.col("model").cast("string")))).join(known, "_model", "left").join(taken, "pos", "left")
    stocked = F.coalesce(F.col("quantity") > 0, F.lit(False))
    status = F.when(F.col("_taken").isNotNull(), S.MATCHED).when(~stocked, S.NOTHING).when(F.col("_known").isNotNull(), S.PUT_UP_SPEC).otherwise(S.PUT_UP)
    bid = F.lit(None).cast("bigint") if profile.margin_only else supply_bid(F.col("discounted_price"), F.col("msrp"), profile.multiplier)
    return rows.select(*supply.drop("status", "bid_price", "sku_id").columns, status.alias("status"), bid.alias("bid_price"), "sku_id")


def three_way(color: Column | None, size: Column, s_color: Column, s_size: Column) -> Column:
    """Colour and size fit, or the size fits and no colour is asked or given, or the colour fits and no size is asked or given."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return F.coalesce((color == s_color) & (size == s_size), F.lit(False)) | F.coalesce(blank(color) & (size == s_size) & blank(s_color), F.lit(False)) | F.coalesce((color == s_color) & blank(size) & blank(s_size), F.lit(False))
