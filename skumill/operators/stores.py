"""Store stock: from pages to one wide row a product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.price import page_price
from ..functions.text import sku_parts


def store_rows(skus: DataFrame, pages: DataFrame, site: str = "") -> DataFrame:
    """STORE_ROW for each SKU: its parts, price, names and stores, or a note on what is missing.

    pages: (item, url, html), one product page an item.  Pages are shuffled, never
    broadcast: a plan may take a page that it composes for some bytes.
    """
    parts = skus.select("sku", sku_parts(F.col("sku")).alias("p"))
    found = parts.join(pages.select(F.col("item").alias("_item"), "url", "html").hint("merge"), F.col("p.item") == F.col("_item"), "left")
    h = F.col("html")
    note = F.when(F.col("p.error").isNotNull(), F.col("p.error")).when(h.isNull(), "product page not found").when(H.is_failover(h), "fail-over page").otherwise("")
    text = lambda c: F.coalesce(c, F.lit(""))
    return found.select(
        "sku",
        text(H.product_name(h, site)).alias("product_name"),
        text(F.col("url")).alias("url"),
        text(F.col("p.color")).alias("color"),
        text(H.color_name(h, F.col("p.color"))).alias("color_name"),
        text(F.col("p.size")).alias("size"),
        text(page_price(h)).alias("price"),
        note.alias("note"),
        F.coalesce(H.stores(h), F.array().cast("array<struct<name:string,status:string>>")).alias("stores"),
    )


def most_stores(rows: DataFrame) -> int:
    """The largest number of stores of a row; 0 for an empty table."""
    return rows.agg(F.coalesce(F.max(F.size("stores")), F.lit(0))).first()[0]


def wide(rows: DataFrame, most: int | None = None) -> DataFrame:
    """shop1, stock1, ... shopN, stockN behind the other columns, '' where a row has fewer; the row is not shuffled."""
    n = most_stores(rows) if most is None else most
    cols = [c for k in range(n) for c in (F.coalesce(F.get("stores", F.lit(k))["name"], F.lit("")).alias(f"shop{k + 1}"), F.coalesce(F.get("stores", F.lit(k))["status"], F.lit("")).alias(f"stock{k + 1}"))]
    return rows.select(*[c for c in rows.columns if c != "stores"], *cols)
