"""Display-ready apps: one aggregate over the members of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled
from ..schema import PACKAGE_FIELDS, PREFERRED
from ..tables import written
from .joins import SHARE


def priority(source: Column | str = "source") -> Column:
    """0, 1 and 2 for the preferred sources, 3 for all others."""
    source = F.col(source) if isinstance(source, str) else source
    out = None
    for rank, name in enumerate(PREFERRED):
        out = (F.when if out is None else out.when)(source == name, rank)
    return out.otherwise(len(PREFERRED))


def pick(value: Column | str, where: Column | None = None) -> Column:
    """The value of the first member of the most preferred source; with `where`, among those for which it holds."""
    order = F.struct(priority(), F.col("ordinal"))
    return F.min_by(value, order if where is None else F.when(where, order))


def pick_description() -> Column:
    """That of the members with a description; empty if none has one."""
    return F.coalesce(pick(F.when(filled("description"), F.col("description")), filled("description")), F.lit(""))


def enrich(labelled: DataFrame, packages: bool = True) -> DataFrame:
    """Labelled packages to (label, id, name, shortDescription, homepage, packages).

    id is the first member's key, name and homepage the representative's; its homepage is not borrowed from another member.
    """
    members = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", *PACKAGE_FIELDS))), lambda x: F.struct(*(x[f].alias(f) for f in PACKAGE_FIELDS)))
    return _grouped(labelled, *([members.alias("packages")] if packages else []))


def enrich_texts(labelled: DataFrame) -> DataFrame:
    """enrich() with packages as JSON text, for groups whose text takes a good part of an executor's memory.

    Each member is a text before the aggregate, so that a group's list is joined once, with no list of rows beside it. Groups of more than
    one in SHARE rows, fewer than SHARE, are gathered apart: among many groups an aggregate turns to sorting, which holds them once
    more. A last shuffle hands rows on, so that whoever writes them holds only the row.
    """
    rows = written(labelled.select("label", "key", "ordinal", *PACKAGE_FIELDS), "labelled")
    large = rows.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > rows.agg(F.count("*") / SHARE).scalar()).select("label")
    large = F.broadcast(written(large, "large-groups"))
    n = F.count("*").cast("int")
    texts = F.sort_array(F.collect_list(F.struct("ordinal", F.col("text").alias("text"))))["text"]  # no transform, which would copy each text
    ends = F.concat(F.lit("["), F.get(texts, F.lit(0))), F.concat(F.get(texts, n - 1), F.lit("]"))
    text = F.when(n == 1, F.concat(ends[0], F.lit("]"))).otherwise(F.concat_ws(",", ends[0], F.slice(texts, F.lit(2), F.greatest(n - 2, F.lit(0))), ends[1]))
    found = (_grouped(rows.join(large, "label", how).withColumn("text", F.to_json(F.struct(*PACKAGE_FIELDS))), text.alias("packages")) for how in ("left_anti", "left_semi"))
    return next(found).union(next(found)).repartition("id")


def _grouped(labelled: DataFrame, *more: Column) -> DataFrame:
    rep = pick(F.struct("name", "homepage"))
    out = labelled.groupBy("label").agg(F.min_by("key", "ordinal").alias("id"), rep.alias("rep"), pick_description().alias("shortDescription"), F.count("*").alias("n_packages"), *more)
    return out.select("label", "id", "rep.name", "shortDescription", "rep.homepage", "n_packages", *(["packages"] if more else []))
