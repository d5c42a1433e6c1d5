"""Deduplication that keeps the last value in the first place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys the one of largest `order`, which takes the smallest `order` of them."""
    values = [c for c in df.columns if c not in keys and c != order]
    last = F.max_by(F.struct(*values), order)
    found = df.groupBy(*keys).agg(last.alias("_last"), F.min(order).alias(order))
    return found.select(*(c if c in keys or c == order else F.col(f"_last.`{c}`") for c in df.columns))
