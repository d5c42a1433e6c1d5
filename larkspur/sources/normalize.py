"""Cache rows of the eight sources as packages, and their ordered union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import last_segment
from ..schema import CACHE, PACKAGE_FIELDS, RANK_BITS, SOURCES, UNKNOWN_VERSION
from .ndjson import read_ordered


def _package(rows: DataFrame, source: str, **fields: Column | str) -> DataFrame:
    def column(name: str) -> Column:
        given = fields.get(name)
        return (F.lit(None) if given is None else F.col(given) if isinstance(given, str) else given).cast("string").alias(name)

    return rows.select(*(c for c in ("line",) if c in rows.columns), F.lit(source).alias("source"), *(column(n) for n in PACKAGE_FIELDS if n != "source"))


def flathub(rows: DataFrame) -> DataFrame:
    return _package(rows, "flathub", name="name", description="summary", version=F.coalesce("version", F.lit(UNKNOWN_VERSION)), appId="id", iconFilename="iconFilename", homepage="homepage")


def snapcraft(rows: DataFrame) -> DataFrame:
    return _package(rows, "snapcraft", name="title", description="summary", version="version", appId="name", channel="channel", iconFilename=last_segment("iconUrl"), homepage="website")


def appimage(rows: DataFrame) -> DataFrame:
    return _package(rows, "appimage", name="name", description="description", version=F.coalesce("version", F.lit(UNKNOWN_VERSION)), appId="repo", iconFilename="iconFilename", homepage="homepage")


def fedora(rows: DataFrame) -> DataFrame:
    return _package(rows, "fedora", name="name", description="summary", version="version", appId="name", homepage="homepage")


def _plain(source: str):
    def normalize(rows: DataFrame) -> DataFrame:
        return _package(rows, source, name="name", description="description", version="version", appId="name", homepage="homepage")

    return normalize


NORMALIZE = {"flathub": flathub, "snapcraft": snapcraft, "appimage": appimage, "aur": _plain("aur"), "debian": _plain("debian"), "ubuntu": _plain("ubuntu"), "fedora": fedora, "arch": _plain("arch")}


def search(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """The packages of one source's cache, {folder}/{source}.ndjson; none if it is missing."""
    return NORMALIZE[source](read_ordered(spark, f"{folder}/{source}.ndjson", CACHE[source]))


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Packages by source to one relation with an ordinal: by the sources' order, then by `line`. Nothing is deduplicated."""
    out = None
    for source, rows in parts.items():
        ranked = rows.withColumn("ordinal", F.lit(SOURCES.index(source) << RANK_BITS) + F.col("line")).select("ordinal", *PACKAGE_FIELDS)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def search_all(spark: SparkSession, folder: str) -> DataFrame:
    return union_sources({s: search(spark, s, folder) for s in SOURCES})
