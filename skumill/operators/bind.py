"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns that later steps use as they are.

    The optimiser merges neighbouring projections, and a column that later steps
    read several times, or inside an array function, would be computed as often; a
    generator between the steps keeps each column computed once a row.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", made.alias("_made")).select(*[c for c in df.columns if c not in columns], "_made.*")
