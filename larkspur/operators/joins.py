"""Joins whose keys are counted, so that one key of a third of all rows does not end in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000  # keys with more than one in so many rows are joined by broadcast: fewer than SHARE of them there can be


def join_counted(left: DataFrame, right: DataFrame, key: str, times: str, how: str = "left") -> DataFrame:
    """left joined with right, which has a row for each key and in `times` how often left has it; how: left or inner.

    Keys that make up more than 1 / SHARE of all rows are fewer than SHARE, whatever the data, and go to every task; rows that have
    found theirs, and rows with a null key, are spread over all tasks of the shuffle that joins the others. right is read three
    times, so it should be a written table. A null key matches nothing.
    """
    most = right.agg(F.sum(times) / SHARE).scalar()
    values = [c for c in right.columns if c not in (key, times)]
    held = F.struct(*(F.col(f"`{c}`") for c in values))
    hot = right.where(F.col(times) > most).select(key, held.alias("_hot"))
    rest = right.where(F.col(times) <= most).select(key, F.lit(0).cast("long").alias("_spread"), held.alias("_rest"))
    names = left.columns
    near = left.join(F.broadcast(hot), key, "left")
    done = F.col("_hot").isNotNull() | F.col(f"`{key}`").isNull()
    spread = F.when(done, F.xxhash64(*(F.col(f"`{c}`") for c in names)).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long"))
    out = near.withColumn("_spread", spread).join(rest, [key, "_spread"], "left").withColumn("_found", F.coalesce("_hot", "_rest"))
    if how == "inner":
        out = out.where("_found is not null")
    return out.select(*(F.col(f"`{c}`") for c in names), *(F.col("_found")[c].alias(c) for c in values))
