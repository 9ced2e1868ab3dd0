"""Declared schemas and the fixed texts of the reconciliation."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


PAGE = _struct(("url", _S), ("status", _I), ("html", _S))
#: Columns of a variant row of a site with a data layer. Fixed values.
VARIANT_COLUMNS = ["type", "title", "model", "u_model", "url", "brand", "color", "size", "msrp", "discounted_price", "stock_status", "quantity"]
#: Columns of a variant row of a site with grouped products. Fixed values.
CATALOGUE_COLUMNS = [
    "title", "model", "sku", "upc_barcode_ean", "brand", "size", "url", "color", "msrp", "discounted_price", "product_main_image",
    "product_other_image", "dimension", "description", "product_spec", "material", "weight", "stock_status", "quantity",
]
VARIANT = _struct(*[(c, _S) for c in VARIANT_COLUMNS])
CATALOGUE = _struct(*[(c, _S) for c in CATALOGUE_COLUMNS])
URL_ROW = _struct(("seed_url", _S), ("product_url", _S))
FAILED_ROW = _struct(("url", _S), ("error", _S))
COLOR_VARIANT = _struct(
    ("code", _S), ("name", _S), ("sizes", T.ArrayType(_S)), ("in_stock_sizes", T.ArrayType(_S)), ("out_of_stock_upcs", T.MapType(_S, _S)), ("sku_by_size", T.MapType(_S, _S)),
    ("upc_by_size", T.MapType(_S, _S)), ("main_image", _S), ("url", _S), ("offer_price", _S), ("msrp", _S), ("discounted_price", _S),
)
STORE_ROW = _struct(("sku", _S), ("product_name", _S), ("url", _S), ("color", _S), ("color_name", _S), ("size", _S), ("price", _S), ("note", _S), ("stores", T.ArrayType(_struct(("name", _S), ("status", _S)))))

#: Supply columns by position; the last three are results. Fixed values.
SUPPLY_POSITIONS = ["model", "size", "msrp", "discounted_price", "color", "quantity", "reserve", "status", "bid_price", "sku_id"]
#: Listing columns by position; the last three are results. Fixed values.
LISTING_POSITIONS = [
    "offer_id", "spu_id", "sku_id", "category", "brand", "barcode", "product_name", "article", "spec", "total_stock", "on_sale", "to_offer", "lead_time", "my_bid", "cost",
    "operating_cost", "expected_income", "expected_gross", "expected_net", "visible", "new_lead_time", "new_bid", "new_stock", "auto_follow", "auto_floor", "shown_price",
    "shown_income", "shown_gross", "shown_net", "shown_sales_30d", "moving_price", "moving_income", "moving_gross", "moving_net", "moving_sales_30d", "sales_30d",
    "average_price_30d", "highest_price_30d", "lowest_price_30d", "status", "old_cost", "bid_price",
]
SUPPLY = _struct(*zip(SUPPLY_POSITIONS[:7], (_S, _S, _D, _D, _S, _I, _S), strict=True))
LISTING = _struct(*[(c, {"lead_time": _I, "my_bid": _D}.get(c, _S)) for c in LISTING_POSITIONS[:39]])

#: Result texts. Fixed values.
NO_MODEL = "没有model匹配到，下架"
NO_SPEC = "没有匹配到天猫的规格(颜色尺码)，下架"
NO_STOCK = "没有库存，下架"
COST_CHANGED = "天猫价格和采购成本(JPY)不一致，已更新O列"
MATCHED = "匹配到"
PUT_UP_SPEC = "该货号没有规格匹配到，得物上架"
PUT_UP = "上架"
NOTHING = "无需处理"
MARGIN = "tianmao价格>=预计收入(JPY),tianmao价格="
