"""XML feeds: AppStream components and RPM primary metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, filled
from ..schema import UNKNOWN_VERSION, struct
from .ndjson import numbered

#: Component types that are applications.
APP_TYPES = ("desktop-application", "desktop", "console-application")
COMPONENT = "_type string, id string, name array<struct<_VALUE: string, `_xml:lang`: string>>, summary array<struct<_VALUE: string, `_xml:lang`: string>>, icon array<struct<_VALUE: string, _type: string>>, url array<struct<_VALUE: string, _type: string>>, releases struct<release: array<struct<_version: string>>>"
PRIMARY = "name string, summary string, version struct<_ver: string>, url string"


def _first(items: Column | str, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(1))


def default_text(entries: Column | str) -> Column:
    """The text of the first entry without a language or in English."""
    return _first(entries, lambda e: e["_xml:lang"].isNull() | e["_xml:lang"].isin("", "en"))["_VALUE"]


def pick_icon(icons: Column | str) -> Column:
    """The first cached icon's text, else the first stock one's, else the first one's."""
    return F.coalesce(_first(icons, lambda i: i["_type"] == "cached")["_VALUE"], _first(icons, lambda i: i["_type"] == "stock")["_VALUE"], F.get(icons, F.lit(0))["_VALUE"])


def pick_homepage(urls: Column | str) -> Column:
    return _first(urls, lambda u: u["_type"] == "homepage")["_VALUE"]


def map_components(components: DataFrame) -> DataFrame:
    """Rows of COMPONENT, other columns kept, to cache rows: applications with an id and a name."""
    fields = {f.name for f in struct(COMPONENT)}
    others = [c for c in components.columns if c not in fields]
    rows = components.where(F.col("_type").isin(*APP_TYPES)).select(
        *others, "id", F.coalesce(default_text("name"), F.lit("")).alias("name"), F.coalesce(default_text("summary"), F.lit("")).alias("summary"),
        F.get(F.col("releases.release"), F.lit(0))["_version"].alias("version"), pick_icon("icon").alias("iconFilename"), pick_homepage("url").alias("homepage"),
    )
    return rows.where(filled("id") & filled("name"))


def parse_components(texts: DataFrame, column: str) -> DataFrame:
    """Texts that each hold one <component> element to cache rows."""
    others = [c for c in texts.columns if c != column]
    return map_components(texts.select(*others, F.from_xml(column, COMPONENT).alias("_x")).select(*others, "_x.*"))


def read_appstream(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", "component").schema(struct(COMPONENT)).load(path)
    return map_components(numbered(rows))


def primary_location(repomd: Column | str) -> Column:
    """Where the primary metadata of a repository index lie; null without them."""
    return empty_to_null(F.regexp_extract(repomd, r'(?s)<data type="primary">.*?<location href="([^"]+)"', 1))


def map_primary(packages: DataFrame) -> DataFrame:
    """Rows of PRIMARY to cache rows; those without a name are dropped."""
    others = [c for c in packages.columns if c not in ("name", "summary", "version", "url")]
    return packages.where(filled("name")).select(
        *others, "name", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("version._ver", F.lit(UNKNOWN_VERSION)).alias("version"), empty_to_null("url").alias("homepage")
    )


def parse_primary(texts: DataFrame, column: str) -> DataFrame:
    others = [c for c in texts.columns if c != column]
    return map_primary(texts.select(*others, F.from_xml(column, PRIMARY).alias("_x")).select(*others, "_x.*"))


def read_primary(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", "package").schema(struct(PRIMARY)).load(path)
    return map_primary(numbered(rows))
