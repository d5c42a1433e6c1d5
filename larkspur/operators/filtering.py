"""Support packages out, hand-made exceptions first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import looks_like_support_package


def filter_packages(packages: DataFrame, keep: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """packages without those in exclude (source, name) and those whose name looks like a support package; what keep names stays in any case.

    The override lists are hand-made; Spark broadcasts them as long as they are under its own limit and shuffles them beyond it.
    """
    out, marks = packages, {}
    for mark, table in (("_keep", keep), ("_exclude", exclude)):
        if table is None:
            marks[mark] = F.lit(False)
        else:
            out = out.join(table.select("source", "name").distinct().withColumn(mark, F.lit(True)), ["source", "name"], "left")
            marks[mark] = F.coalesce(mark, F.lit(False))
    return out.where(marks["_keep"] | ~marks["_exclude"] & ~F.coalesce(looks_like_support_package("name"), F.lit(False))).select(packages.columns)
