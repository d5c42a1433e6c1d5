"""JSON feeds: snaps by category, AppImage items, and the AUR dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filled, last_segment
from ..operators.dedup import keep_last
from ..schema import UNKNOWN_VERSION, struct
from .ndjson import numbered

SNAP = "name string, revision struct<channel: string, version: string>, snap struct<title: string, summary: string, media: array<struct<type: string, url: string>>, links: struct<website: array<string>>>"
ITEM = "name string, description string, links array<struct<type: string, url: string>>, icons array<string>"
AUR = "Name string, Description string, Version string, URL string"


def map_snaps(results: DataFrame) -> DataFrame:
    """Rows of SNAP, other columns kept, to cache rows; those without a name are dropped."""
    others = [c for c in results.columns if c not in ("name", "revision", "snap")]
    icon = F.try_element_at(F.filter("snap.media", lambda m: m["type"] == "icon"), F.lit(1))["url"]
    return results.where(filled("name")).select(
        *others, "name", F.coalesce("snap.title", "name").alias("title"), F.coalesce("snap.summary", F.lit("")).alias("summary"), F.coalesce("revision.version", F.lit(UNKNOWN_VERSION)).alias("version"),
        F.coalesce("revision.channel", F.lit("stable")).alias("channel"), icon.alias("iconUrl"), F.get("snap.links.website", F.lit(0)).alias("website"),
    )


def read_snaps(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Answers {results: [...]} by category, in that order. Of a name that occurs again the last entry counts, in the first one's place."""
    out = None
    for rank, path in enumerate(paths.values()):
        body = spark.read.schema(struct(f"results array<struct<{_nested(SNAP)}>>")).option("multiLine", True).json(path)
        rows = body.select(F.posexplode("results").alias("line", "x")).select((F.col("line") + F.lit(rank << 40)).alias("line"), "x.*")
        out = rows if out is None else out.unionByName(rows)
    return keep_last(map_snaps(out), ["name"], "line")


def map_items(items: DataFrame) -> DataFrame:
    """Rows of ITEM to cache rows; without a name, or a URL in the first GitHub link, they are dropped."""
    others = [c for c in items.columns if c not in ("name", "description", "links", "icons")]
    repo = F.try_element_at(F.filter("links", lambda x: x["type"] == "GitHub"), F.lit(1))["url"]
    rows = items.select(*others, "name", "description", "icons", repo.alias("repo")).where(filled("name") & filled("repo"))
    return rows.select(
        *others, "name", F.coalesce("description", F.lit("")).alias("description"), "repo", F.lit(None).cast("string").alias("version"),
        last_segment(F.get("icons", F.lit(0))).alias("iconFilename"), F.concat(F.lit("https://github.com/"), "repo").alias("homepage"),
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    body = spark.read.schema(struct(f"items array<struct<{_nested(ITEM)}>>")).option("multiLine", True).json(path)
    return map_items(body.select(F.posexplode("items").alias("line", "x")).select(F.col("line").cast("long"), "x.*"))


def map_aur(packages: DataFrame) -> DataFrame:
    """Rows of AUR to cache rows; those without a name are dropped, an empty URL stays."""
    others = [c for c in packages.columns if c not in ("Name", "Description", "Version", "URL")]
    return packages.where(filled("Name")).select(
        *others, F.col("Name").alias("name"), F.coalesce("Description", F.lit("")).alias("description"), F.coalesce("Version", F.lit(UNKNOWN_VERSION)).alias("version"), F.col("URL").alias("homepage")
    )


def read_aur(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(struct(AUR)).option("multiLine", True).json(path)
    return map_aur(numbered(rows))


def _nested(ddl: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in struct(ddl))
