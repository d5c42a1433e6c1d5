"""Entity resolution: packages to groups, by forced pairs and exact keys, with forbidden pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, normalize_name, package_key, pair_key
from ..tables import written
from .components import components

GHOST = 1 << 62  # above every ordinal


def key_edges(packages: DataFrame, value: Column, deny: DataFrame | None = None) -> DataFrame:
    """(ordinal, key_a, key_b): each package with the first of the same value, unless their pair is denied.

    Null and empty values link nothing. The first is found before pairs are denied; a denied row does not take its place.
    One row a package comes out, however many share a value: the first is an aggregate, joined back.
    """
    rows = packages.select("ordinal", package_key().alias("key_b"), value.alias("value")).where(filled("value"))
    first = rows.groupBy("value").agg(F.min_by("key_b", "ordinal").alias("key_a"), F.min("ordinal").alias("first"))
    edges = rows.join(first, "value").where("ordinal <> first").select("ordinal", "key_a", "key_b")
    if deny is None:
        return edges
    return edges.withColumn("pair", pair_key("key_a", "key_b")).join(deny.select("pair"), "pair", "left_anti").select("ordinal", "key_a", "key_b")


def app_id_edges(packages: DataFrame, deny: DataFrame | None = None) -> DataFrame:
    return key_edges(packages, F.col("appId"), deny)


def name_edges(packages: DataFrame, deny: DataFrame | None = None) -> DataFrame:
    return key_edges(packages, normalize_name("name"), deny)


def _star(keyed: DataFrame, value: str, deny: DataFrame | None) -> DataFrame:
    """(a, b): the vertices of each value's first package and of every other one, unless the pair of their keys is denied."""
    rows = keyed.where(filled(value)).select("ordinal", "key", "v", value)
    first = rows.groupBy(value).agg(F.min_by("key", "ordinal").alias("key_a"), F.min_by("v", "ordinal").alias("a"), F.count("*").alias("n")).where("n > 1")
    edges = rows.join(first, value).where("a <> v").select("a", F.col("v").alias("b"), "key_a", "key")
    if deny is not None:
        edges = edges.withColumn("pair", pair_key("key_a", "key")).join(deny.select("pair"), "pair", "left_anti")
    return edges.select("a", "b")


def group_labels(packages: DataFrame, manual: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """packages to (key, label): the label of a package key is the smallest ordinal in its group.

    Rows with one key are one vertex, denied or not. manual (key_a, key_b) links whatever deny (pair) says, and may name
    packages that are not there: those connect others, and vanish.
    """
    rows = packages.select("ordinal", package_key().alias("key"), F.col("appId").alias("id"), normalize_name("name").alias("name"))
    vertices = rows.groupBy("key").agg(F.min("ordinal").alias("v"))
    keyed = written(rows.join(vertices, "key"), "keyed")
    vertices = keyed.where("ordinal = v").select("key", "v").distinct()
    edges = _star(keyed, "id", deny).union(_star(keyed, "name", deny))
    if manual is not None:
        forced = manual.select("key_a", "key_b")
        for side in "ab":
            known = vertices.select(F.col("key").alias(f"key_{side}"), F.col("v").alias(side))
            ghost = F.lit(GHOST).bitwiseOR(F.xxhash64(f"key_{side}").bitwiseAND(F.lit(GHOST - 1)))
            forced = forced.join(known, f"key_{side}", "left").withColumn(side, F.coalesce(side, ghost))
        edges = edges.union(forced.where("key_a <> key_b").select("a", "b"))
    found = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return vertices.join(found.withColumnRenamed("vertex", "v"), "v", "left").select("key", F.coalesce("component", "v").alias("label"))


def labelled(packages: DataFrame, manual: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """packages with the label of their group, the ordinal of its first member."""
    return packages.withColumn("key", package_key()).join(group_labels(packages, manual, deny), "key")


def group_packages(packages: DataFrame, manual: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """(label, id, packages): groups in the order of label, members in input order, id the first member's key."""
    members = F.transform(F.array_sort(F.collect_list(F.struct(*packages.columns))), lambda x: x)
    return labelled(packages, manual, deny).groupBy("label").agg(F.min_by("key", "ordinal").alias("id"), members.alias("packages"))
