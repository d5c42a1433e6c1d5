"""Refreshing a source's cache from the raw files that a downloader has put into a landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SOURCES
from . import archdesc, deb822, jsonfeeds, xmlfeeds
from .ndjson import now, write_metadata

#: The store categories whose answers make up the snap cache, in order.
SNAP_CATEGORIES = "art-and-design books-and-reference development devices-and-iot education entertainment featured finance games health-and-fitness music-and-audio news-and-weather personalisation photo-and-video productivity science security server-and-cloud social utilities".split()

Found = tuple[DataFrame, dict]


def _fedora(spark: SparkSession, at: str) -> Found:
    index = spark.read.text(f"{at}/repomd.xml", wholetext=True).select(xmlfeeds.primary_location("value").alias("x")).first()["x"]
    if index is None:
        raise ValueError(f"{at}/repomd.xml names no primary metadata")
    return xmlfeeds.read_primary(spark, f"{at}/{index}"), {"release": "44", "arch": "x86_64"}


def _appimage(spark: SparkSession, at: str) -> Found:
    total = spark.read.schema("items array<string>").option("multiLine", True).json(f"{at}/feed.json").select(F.coalesce(F.size("items"), F.lit(0)).alias("n")).first()["n"]
    return jsonfeeds.read_items(spark, f"{at}/feed.json"), {"totalFeedItems": total}


#: Each source's raw files below its landing folder, as rows of its cache, with the metadata of its own.
READ: dict[str, Callable[[SparkSession, str], Found]] = {
    "flathub": lambda s, at: (xmlfeeds.read_appstream(s, f"{at}/appstream.xml.gz"), {"arch": "x86_64"}),
    "snapcraft": lambda s, at: (jsonfeeds.read_snaps(s, {c: f"{at}/{c}.json" for c in SNAP_CATEGORIES}), {"deviceSeries": "16", "categoriesSwept": SNAP_CATEGORIES}),
    "appimage": _appimage,
    "aur": lambda s, at: (jsonfeeds.read_aur(s, f"{at}/packages.json.gz"), {}),
    "debian": lambda s, at: (deb822.read_packages(s, {"main": f"{at}/main/Packages.gz"}), {"suite": "stable", "component": "main", "arch": "amd64"}),
    "ubuntu": lambda s, at: (deb822.read_packages(s, {c: f"{at}/{c}/Packages.gz" for c in ("main", "universe")}), {"suite": "resolute", "component": "main,universe", "arch": "amd64"}),
    "fedora": _fedora,
    "arch": lambda s, at: (archdesc.read_repos(s, {r: f"{at}/{r}.db.tar.gz" for r in ("core", "extra")}), {"repos": ["core", "extra"], "arch": "x86_64"}),
}


def refresh(spark: SparkSession, source: str, landing: str, caches: str) -> int:
    """Parses {landing}/{source} into {caches}/{source}.ndjson and its sidecar; gives the number of rows. An unknown source raises."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source}; there are: {', '.join(SOURCES)}")
    at, path = f"{landing}/{source}", f"{caches}/{source}.ndjson"
    rows, own = READ[source](spark, at)
    rows.orderBy("line").drop("line").coalesce(1).write.mode("overwrite").json(path)
    count = spark.read.text(path).count()
    write_metadata(spark, path, {"source": source, "fetchedAt": now(), "url": at, "entryCount": count, **own})
    return count
