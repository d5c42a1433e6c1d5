"""Views of the driver's tables as packages. They stand in for source caches, which are not shipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SOURCES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source(index) -> F.Column:
    return F.element_at(F.array(*map(F.lit, SOURCES)), index + 1)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as packages: named by the first line, identified by the letters and digits of the last one."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"), _source((F.substring("source", 4, 9).cast("int") % 8)).alias("source"), F.coalesce(F.get(lines, F.lit(0)), F.lit("")).alias("name"),
        F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("text")).alias("description"), F.lit("1").alias("version"),
        F.regexp_replace(F.lower(F.element_at(lines, -1)), "[^a-z0-9]", "").alias("appId"), F.lit(None).cast("string").alias("channel"), F.lit(None).cast("string").alias("iconFilename"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string"))).alias("homepage"), F.lit(None).cast("string").alias("arch"), F.lit(None).cast("string").alias("lastUpdated"),
    )


DOCS = """pkgs_docs AS (SELECT doc_id AS ordinal, ['flathub','snapcraft','appimage','aur','debian','ubuntu','fedora','arch'][CAST(substr(source, 4) AS INT) % 8 + 1] AS source,
  coalesce(string_split(text, chr(10))[1], '') AS name, CASE WHEN doc_id % 5 = 0 THEN '' ELSE text END AS description,
  regexp_replace(lower(string_split(text, chr(10))[-1]), '[^a-z0-9]', '', 'g') AS appId,
  CASE WHEN doc_id % 3 <> 0 THEN 'https://example.org/' || doc_id END AS homepage FROM documents)"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as packages of all shapes of names that the filter knows."""
    k, slug = F.col("p_partkey"), F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "-")
    name = F.when(k % 5 == 0, F.concat(F.lit("lib"), slug, F.col("p_size").cast("string"))).when(k % 5 == 1, F.concat(slug, F.lit("-dev"))).when(k % 5 == 2, F.concat(F.lit("fonts-"), slug)).when(k % 5 == 3, slug).otherwise(F.concat(slug, F.lit("-docs")))
    return table(spark, sf_dir, "part").select(
        k.alias("ordinal"), F.lower("p_brand").alias("source"), name.alias("name"), F.col("p_type").alias("description"), F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("version"),
        F.when(k % 7 != 0, slug).alias("appId"), F.concat(F.col("p_size").cast("string"), F.lit(".png")).alias("iconFilename"),
    )


PARTS = """pkgs_parts AS (SELECT p_partkey AS ordinal, lower(p_brand) AS source, CASE p_partkey % 5 WHEN 0 THEN 'lib' || slug || p_size WHEN 1 THEN slug || '-dev' WHEN 2 THEN 'fonts-' || slug WHEN 3 THEN slug ELSE slug || '-docs' END AS name,
  p_type AS description, p_size || '.0' AS version, CASE WHEN p_partkey % 7 <> 0 THEN slug END AS appId, p_size || '.png' AS iconFilename
  FROM (SELECT *, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') AS slug FROM part))"""
SUPPORT = r"(regexp_matches(name, '-(dev|dbg|dbgsym|docs?)$') OR regexp_matches(name, '^lib[\w.+-]*\d$') OR regexp_matches(name, '^(ttf|fonts|otf)-'))"


def united(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight tables, or halves of them, as cache rows of the eight sources, normalised and united in the sources' order."""
    from ..sources.normalize import NORMALIZE, union_sources

    t = lambda name: table(spark, sf_dir, name)
    none = F.lit(None).cast("string")
    caches = {
        "flathub": t("part").select(F.col("p_partkey").alias("line"), F.concat(F.lit("org.part."), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("summary"), none.alias("version"), none.alias("iconFilename"), none.alias("homepage")),
        "snapcraft": t("supplier").select(F.col("s_suppkey").alias("line"), F.lower("s_name").alias("name"), F.col("s_name").alias("title"), F.lit("").alias("summary"), F.lit("1").alias("version"), F.lit("stable").alias("channel"), F.concat(F.lit("https://example.org/icons/"), F.col("s_suppkey").cast("string"), F.lit(".png")).alias("iconUrl"), none.alias("website")),
        "appimage": t("pages").select(F.col("page_id").alias("line"), F.concat(F.lit("app"), F.col("page_id").cast("string")).alias("name"), F.lit("").alias("description"), F.concat(F.lit("owner/"), F.col("page_id").cast("string")).alias("repo"), none.alias("version"), none.alias("iconFilename"), F.col("url").alias("homepage")),
        "aur": t("customer").select(F.col("c_custkey").alias("line"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"), F.lit("1").alias("version"), F.lit("").alias("homepage")),
        "debian": t("nation").select(F.col("n_nationkey").cast("long").alias("line"), F.col("n_name").alias("name"), F.lit("").alias("description"), F.lit("1").alias("version"), none.alias("homepage"), F.lit("main").alias("component")),
        "ubuntu": t("orders").select(F.col("o_orderkey").cast("long").alias("line"), F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_orderstatus").alias("description"), F.lit("2").alias("version"), none.alias("homepage"), F.lit("universe").alias("component")),
        "fedora": t("supplier").select(F.col("s_suppkey").cast("long").alias("line"), F.col("s_name").alias("name"), F.lit("rpm").alias("summary"), F.col("s_nationkey").cast("string").alias("version"), F.lit("https://example.org/").alias("homepage")),
        "arch": t("region").select(F.col("r_regionkey").cast("long").alias("line"), F.col("r_name").alias("name"), F.lit("").alias("description"), F.lit("1").alias("version"), none.alias("homepage"), F.lit("core").alias("repo")),
    }
    return union_sources({s: NORMALIZE[s](rows) for s, rows in caches.items()})


UNITED = """pkgs_union AS (SELECT 0 * 281474976710656 + p_partkey AS ordinal, 'flathub' AS source, p_name AS name, p_type AS description, 'unknown' AS version, 'org.part.' || p_partkey AS appId, NULL AS channel, NULL AS iconFilename, NULL AS homepage FROM part
  UNION ALL SELECT 281474976710656 + s_suppkey, 'snapcraft', s_name, '', '1', lower(s_name), 'stable', s_suppkey || '.png', NULL FROM supplier
  UNION ALL SELECT 2 * 281474976710656 + page_id, 'appimage', 'app' || page_id, '', 'unknown', 'owner/' || page_id, NULL, NULL, url FROM pages
  UNION ALL SELECT 3 * 281474976710656 + c_custkey, 'aur', c_name, c_mktsegment, '1', c_name, NULL, NULL, '' FROM customer
  UNION ALL SELECT 4 * 281474976710656 + n_nationkey, 'debian', n_name, '', '1', n_name, NULL, NULL, NULL FROM nation
  UNION ALL SELECT 5 * 281474976710656 + o_orderkey, 'ubuntu', 'order-' || o_orderkey, o_orderstatus, '2', 'order-' || o_orderkey, NULL, NULL, NULL FROM orders
  UNION ALL SELECT 6 * 281474976710656 + s_suppkey, 'fedora', s_name, 'rpm', CAST(s_nationkey AS VARCHAR), s_name, NULL, NULL, 'https://example.org/' FROM supplier
  UNION ALL SELECT 7 * 281474976710656 + r_regionkey, 'arch', r_name, '', '1', r_name, NULL, NULL, NULL FROM region)"""
