"""The queries by name, and the DuckDB text of each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import enrich as E
from ..operators import matching as M
from ..operators.dedup import keep_last
from ..operators.filtering import filter_packages
from ..schema import APPS
from ..sinks import store
from ..sources import archdesc, deb822, jsonfeeds, xmlfeeds
from ..sources.ndjson import PLACE_BITS, load_filter_overrides, load_match_overrides, move, read_metadata, read_ndjson, read_ordered, write_metadata, write_ndjson
from ..tables import shared_dir
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("SELECT doc_id, regexp_replace(lower(string_split(text, chr(10))[1]), '[^a-z0-9]', '', 'g') AS normalized FROM documents")
def normalize_names(spark, d):
    return A.table(spark, d, "documents").select("doc_id", X.normalize_name(F.get(F.split("text", "\n"), F.lit(0))).alias("normalized"))


@query(rf"WITH {A.PARTS} SELECT ordinal, name, regexp_matches(name, '-(dev|dbg|dbgsym|docs?)$') AS by_suffix, regexp_matches(name, '^lib[\w.+-]*\d$') AS by_soname, regexp_matches(name, '^(ttf|fonts|otf)-') AS by_font FROM pkgs_parts")
def support_flags(spark, d):
    return A.parts(spark, d).select("ordinal", "name", *(F.col("name").rlike(p).alias(n) for n, p in zip(("by_suffix", "by_soname", "by_font"), X.SUPPORT, strict=True)))


@query(f"WITH {A.PARTS} SELECT ordinal, source, name FROM pkgs_parts WHERE NOT {A.SUPPORT}")
def filter_auto(spark, d):
    return filter_packages(A.parts(spark, d)).select("ordinal", "source", "name")


def _overrides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = A.parts(spark, d)
    return p.where("ordinal % 11 = 0"), p.where("ordinal % 13 = 0 or ordinal % 143 = 0")


@query(f"WITH {A.PARTS} SELECT ordinal, source, name FROM pkgs_parts p WHERE EXISTS (SELECT 1 FROM pkgs_parts k WHERE k.ordinal % 11 = 0 AND k.source = p.source AND k.name = p.name) OR (NOT EXISTS (SELECT 1 FROM pkgs_parts x WHERE x.ordinal % 13 = 0 AND x.source = p.source AND x.name = p.name) AND NOT {A.SUPPORT})")
def filter_keep_exclude(spark, d):
    return filter_packages(A.parts(spark, d), *_overrides(spark, d)).select("ordinal", "source", "name")


@query(f"WITH {A.PARTS} SELECT source, count(*) AS packages, count(*) FILTER (WHERE {A.SUPPORT}) AS dropped FROM pkgs_parts GROUP BY source")
def filter_selectivity_by_source(spark, d):
    return A.parts(spark, d).groupBy("source").agg(F.count("*").alias("packages"), F.count_if(X.looks_like_support_package("name")).alias("dropped"))


@query(f"WITH {A.UNITED} SELECT ordinal, source, name, description, version, appId, channel, iconFilename, homepage FROM pkgs_union")
def union_sources_ordered(spark, d):
    return A.united(spark, d).select("ordinal", "source", "name", "description", "version", "appId", "channel", "iconFilename", "homepage")


@query(f"WITH {A.UNITED} SELECT source, count(*) AS entries, count(DISTINCT name) AS names FROM pkgs_union GROUP BY source")
def source_counts(spark, d):
    return A.united(spark, d).groupBy("source").agg(F.count("*").alias("entries"), F.count_distinct("name").alias("names"))


@query(f"WITH {A.DOCS}, {A.PARTS} SELECT ordinal, source || ':' || coalesce(appId, name) AS key FROM pkgs_docs UNION ALL SELECT ordinal, source || ':' || coalesce(appId, name) FROM pkgs_parts")
def package_keys(spark, d):
    return A.docs(spark, d).select("ordinal", X.package_key().alias("key")).union(A.parts(spark, d).select("ordinal", X.package_key().alias("key")))


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b, least('debian:' || a.n_name, 'arch:' || b.n_name) || '|' || greatest('debian:' || a.n_name, 'arch:' || b.n_name) AS pair FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey")
def pair_keys(spark, d):
    n = A.table(spark, d, "nation")
    a, b = n.select("n_regionkey", F.col("n_nationkey").alias("a"), F.struct(F.lit("debian").alias("source"), F.col("n_name").alias("appId")).alias("x")), n.select("n_regionkey", F.col("n_nationkey").alias("b"), F.struct(F.lit("arch").alias("source"), F.col("n_name").alias("appId")).alias("y"))
    return a.join(b, "n_regionkey").select("a", "b", X.pair_key(X.ref_key("x"), X.ref_key("y")).alias("pair"))


def _edges_sql(value: str) -> str:
    return f"SELECT ordinal, first_value(key) OVER w AS key_a, key AS key_b, first_value(ordinal) OVER w AS first FROM (SELECT ordinal, source || ':' || coalesce(appId, name) AS key, {value} AS value FROM pkgs_docs) WHERE value <> '' WINDOW w AS (PARTITION BY value ORDER BY ordinal)"


TIER1, TIER2 = _edges_sql("appId"), _edges_sql("regexp_replace(lower(name), '[^a-z0-9]', '', 'g')")


@query(f"WITH {A.DOCS}, e AS ({TIER1}) SELECT ordinal, key_a, key_b FROM e WHERE ordinal <> first")
def tier1_edges(spark, d):
    return M.app_id_edges(A.docs(spark, d))


@query(f"WITH {A.DOCS}, e AS ({TIER2}) SELECT ordinal, key_a, key_b FROM e WHERE ordinal <> first")
def tier2_edges(spark, d):
    return M.name_edges(A.docs(spark, d))


def _deny(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of every seventh package with the first one that shares its name."""
    return M.name_edges(A.docs(spark, d)).where("ordinal % 7 = 0").select(X.pair_key("key_a", "key_b").alias("pair")).distinct()


PAIR = "least(key_a, key_b) || '|' || greatest(key_a, key_b)"
DENIED = f"e AS ({TIER2}), denied AS (SELECT DISTINCT {PAIR} AS pair FROM e WHERE ordinal <> first AND ordinal % 7 = 0)"


@query(f"WITH {A.DOCS}, {DENIED} SELECT ordinal, key_a, key_b FROM e WHERE ordinal <> first AND {PAIR} NOT IN (SELECT pair FROM denied)")
def edges_minus_deny(spark, d):
    return M.name_edges(A.docs(spark, d), _deny(spark, d))


LABELS = """v AS (SELECT source || ':' || coalesce(appId, name) AS key, min(ordinal) AS v FROM pkgs_docs GROUP BY 1),
  bidi AS (SELECT key_a AS s, key_b AS t FROM links UNION SELECT key_b, key_a FROM links UNION SELECT key, key FROM v),
  reach AS (SELECT key AS s, key AS t FROM v UNION SELECT r.s, b.t FROM reach r JOIN bidi b ON r.t = b.s),
  labels AS (SELECT r.s AS key, min(v.v) AS label FROM reach r JOIN v ON v.key = r.t GROUP BY r.s)"""
LINKS = f"links AS (SELECT key_a, key_b FROM ({TIER1}) WHERE ordinal <> first UNION SELECT key_a, key_b FROM ({TIER2}) WHERE ordinal <> first)"
LABELLED = f"WITH RECURSIVE {A.DOCS}, {LINKS}, {LABELS}, m AS (SELECT p.*, l.key, l.label FROM pkgs_docs p JOIN labels l ON l.key = p.source || ':' || coalesce(p.appId, p.name))"


@query(f"{LABELLED} SELECT DISTINCT key, label FROM m")
def components(spark, d):
    return M.group_labels(A.docs(spark, d))


MANUAL_SQL = "manual AS (SELECT a.source || ':' || coalesce(a.appId, a.name) AS key_a, 'ghost:' || (a.ordinal % 10) AS key_b FROM pkgs_docs a WHERE a.ordinal % 50 < 2)"


@query(f"WITH RECURSIVE {A.DOCS}, {MANUAL_SQL}, {DENIED}, links AS (SELECT key_a, key_b FROM ({TIER1}) WHERE ordinal <> first AND {PAIR} NOT IN (SELECT pair FROM denied) UNION SELECT key_a, key_b FROM e WHERE ordinal <> first AND {PAIR} NOT IN (SELECT pair FROM denied) UNION SELECT key_a, key_b FROM manual), {LABELS.replace('SELECT key, key FROM v', 'SELECT key, key FROM v UNION SELECT key_b, key_b FROM manual')} SELECT key, label FROM labels")
def components_manual_ghost(spark, d):
    p = A.docs(spark, d)
    manual = p.where("ordinal % 50 < 2").select(X.package_key().alias("key_a"), F.concat(F.lit("ghost:"), (F.col("ordinal") % 10).cast("string")).alias("key_b"))
    return M.group_labels(p, manual, _deny(spark, d))


@query(f"{LABELLED} SELECT label, arg_min(key, ordinal) AS id, count(*) AS n_packages FROM m GROUP BY label")
def group_ids_and_sizes(spark, d):
    return M.labelled(A.docs(spark, d)).groupBy("label").agg(F.min_by("key", "ordinal").alias("id"), F.count("*").alias("n_packages"))


@query(f"{LABELLED} SELECT label, arg_min(key, ordinal) AS id, string_agg(CAST(ordinal AS VARCHAR), ',' ORDER BY ordinal) AS members FROM m GROUP BY label")
def group_members_ordered(spark, d):
    return M.group_packages(A.docs(spark, d)).select("label", "id", F.array_join(F.transform("packages", lambda p: p["ordinal"].cast("string")), ",").alias("members"))


PRIORITY = "(CASE source WHEN 'flathub' THEN 0 WHEN 'snapcraft' THEN 1 WHEN 'appimage' THEN 2 ELSE 3 END, ordinal)"


@query(f"WITH {A.UNITED} SELECT substr(name, 1, 1) AS letter, arg_min(name, {PRIORITY}) AS name, arg_min(source, {PRIORITY}) AS source FROM pkgs_union GROUP BY 1")
def representative_pick(spark, d):
    found = A.united(spark, d).groupBy(F.substring("name", 1, 1).alias("letter")).agg(E.pick(F.struct("name", "source")).alias("rep"))
    return found.select("letter", "rep.name", "rep.source")


@query(f"WITH {A.DOCS} SELECT source || appId[1:2] AS bucket, coalesce(arg_min(description, {PRIORITY}) FILTER (WHERE description <> ''), '') AS description FROM pkgs_docs GROUP BY 1")
def description_fallback(spark, d):
    return A.docs(spark, d).groupBy(F.concat("source", F.substring("appId", 1, 2)).alias("bucket")).agg(E.pick_description().alias("description"))


#: A package's JSON: its fields in order, without those that are null.
PACKAGES = """'[' || string_agg('{"source":' || to_json(source) || ',"name":' || to_json(name) || coalesce(',"description":' || to_json(description), '') || ',"version":"1"'
  || coalesce(',"appId":' || to_json(appId), '') || coalesce(',"homepage":' || to_json(homepage), '') || '}', ',' ORDER BY ordinal) || ']'"""
CURATED = f"{LABELLED}, apps AS (SELECT label, arg_min(key, ordinal) AS id, arg_min(name, {PRIORITY}) AS name, coalesce(arg_min(description, {PRIORITY}) FILTER (WHERE description <> ''), '') AS shortDescription, arg_min(coalesce(homepage, '-'), {PRIORITY}) AS home, count(*) AS n_packages, {PACKAGES} AS packages FROM m GROUP BY label)"
KEPT = CURATED.replace("pkgs_docs AS (SELECT", "all_docs AS (SELECT", 1).replace(", links AS", f", pkgs_docs AS (SELECT * FROM all_docs WHERE NOT {A.SUPPORT}), links AS", 1)


@query(f"{KEPT} SELECT label, id, name, shortDescription, nullif(home, '-') AS homepage, n_packages, packages FROM apps")
def enrich_apps(spark, d):
    return E.enrich_texts(M.labelled(filter_packages(A.docs(spark, d))))


@query("SELECT p_partkey, n_nationkey, CAST(levenshtein(lower(p_name), lower(n_name)) AS INT) AS distance FROM part JOIN nation ON p_partkey % 25 = n_nationkey")
def levenshtein_names(spark, d):
    return _names(spark, d).select("p_partkey", "n_nationkey", X.levenshtein_distance("p_name", "n_name").alias("distance"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    return A.table(spark, d, "part").join(A.table(spark, d, "nation"), F.col("p_partkey") % 25 == F.col("n_nationkey"))


@query("SELECT p_partkey, n_nationkey, round(1 - levenshtein(lower(p_name), lower(n_name)) / CAST(greatest(length(p_name), length(n_name)) AS DOUBLE), 9) AS similarity FROM part JOIN nation ON p_partkey % 25 = n_nationkey")
def similarity_names(spark, d):
    return _names(spark, d).select("p_partkey", "n_nationkey", F.round(X.levenshtein_similarity("p_name", "n_name"), 9).alias("similarity"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    p = A.parts(spark, d).withColumn("block", F.floor(F.col("ordinal") / 4))
    a, b = (p.select("block", F.struct("ordinal", "source", "name", "appId", "iconFilename").alias(x)) for x in "ab")
    return a.join(b, "block").where("a.ordinal < b.ordinal")


SIMILARITY = "(1 - levenshtein(lower(a.name), lower(b.name)) / CAST(greatest(length(a.name), length(b.name)) AS DOUBLE))"
SCORE = f"({SIMILARITY} * 0.5 + (CASE WHEN a.appId <> '' AND a.appId = b.appId THEN 0.35 ELSE 0 END) + (CASE WHEN a.iconFilename <> '' AND a.iconFilename = b.iconFilename THEN 0.15 ELSE 0 END))"
PAIRS = "pkgs_parts a JOIN pkgs_parts b ON a.ordinal // 4 = b.ordinal // 4 AND a.ordinal < b.ordinal"


@query(f"WITH {A.PARTS} SELECT a.ordinal AS a, b.ordinal AS b, round({SCORE}, 9) AS score FROM {PAIRS}")
def score_match(spark, d):
    return _pairs(spark, d).select("a.ordinal", F.col("b.ordinal").alias("b_ordinal"), F.round(X.score_match(), 9).alias("score")).toDF("a", "b", "score")


@query(f"WITH {A.PARTS} SELECT count(*) AS pairs, count(*) FILTER (WHERE {SCORE} >= 0.75 AND coalesce(a.appId, '') <> coalesce(b.appId, '-') AND a.name <> b.name) AS above FROM {PAIRS}")
def score_threshold_bound(spark, d):
    unlike = (F.coalesce("a.appId", F.lit("")) != F.coalesce("b.appId", F.lit("-"))) & (F.col("a.name") != F.col("b.name"))
    return _pairs(spark, d).agg(F.count("*").alias("pairs"), F.count_if((X.score_match() >= 0.75) & unlike).alias("above"))


@query("SELECT user_id, event_type, arg_max(value, event_id) AS value, min(event_id) AS event_id FROM events GROUP BY ALL")
def dedup_keep_last(spark, d):
    return keep_last(A.table(spark, d, "events").select("user_id", "event_type", "value", "event_id"), ["user_id", "event_type"], "event_id")


@query("SELECT page_id, string_split(url, '/')[-1] AS segment FROM pages")
def last_path_segment(spark, d):
    return A.table(spark, d, "pages").select("page_id", X.last_segment("url").alias("segment"))


@query("SELECT doc_id, nullif(CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE lang END, '') AS or_null, coalesce(CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE lang END, 'unknown') AS or_default FROM documents")
def homepage_default_null_vs_empty(spark, d):
    x = F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 != 1, F.col("lang"))
    return A.table(spark, d, "documents").select("doc_id", X.empty_to_null(x).alias("or_null"), F.coalesce(x, F.lit("unknown")).alias("or_default"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return A.table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation")
def ndjson_round_trip(spark, d):
    path = f"{shared_dir(spark)}/larkspur/nation-{uuid4().hex}.ndjson"
    write_ndjson(A.table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name")), path, None)
    return read_ndjson(spark, path, "key long, name string")


@query("SELECT p_partkey AS key, p_name AS name, p_type AS description, CAST(p_size AS VARCHAR) AS version, CASE WHEN p_size % 2 = 0 THEN 'https://example.org/' || p_partkey END AS homepage, 'main' AS component FROM part")
def deb822_round_trip(spark, d):
    home = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string"))).otherwise("")
    text = F.concat(F.lit("Package: old\nPackage: "), "p_name", F.lit("\r\nVersion: "), F.col("p_size").cast("string"), F.lit("\nDescription: "), "p_type", F.lit("\n Version: 0\n\tmore\nHomepage:  "), home, F.lit(" \n\n\n\nVersion: 1\n"))
    return deb822.parse_packages(A.table(spark, d, "part").select(F.col("p_partkey").alias("key"), text.alias("text")), "main").drop("position")


@query("SELECT s_suppkey AS key, s_name AS name, '' AS description, CAST(s_nationkey AS VARCHAR) AS version, CASE WHEN s_suppkey % 2 = 0 THEN 'https://example.org/' || s_suppkey END AS homepage, 'core' AS repo FROM supplier")
def archdesc_round_trip(spark, d):
    home = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("\n\n%URL%\nhttps://example.org/"), F.col("s_suppkey").cast("string"))).otherwise("")
    text = F.concat(F.lit("%FILENAME%\nx\n\n%NAME%\n"), "s_name", F.lit("\nsecond\n\n\n%VERSION%\n"), F.col("s_nationkey").cast("string"), home, F.lit("\n\n%DESC%\n\n"))
    return archdesc.map_desc(A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), text.alias("content")), "core")


def _escaped(x: str) -> F.Column:
    return F.replace(F.replace(F.col(x), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query("SELECT p_partkey AS key, 'org.part.' || p_partkey AS id, p_name AS name, p_type AS summary, CAST(p_size AS VARCHAR) AS version, p_partkey || '.png' AS iconFilename, 'https://example.org/?a=1&b=' || p_partkey AS homepage FROM part WHERE p_partkey % 3 <> 0")
def appstream_round_trip(spark, d):
    k = F.col("p_partkey").cast("string")
    kind = F.when(F.col("p_partkey") % 3 == 0, "runtime").otherwise("desktop-application")
    xml = F.concat(
        F.lit('<component type="'), kind, F.lit('"><id>org.part.'), k, F.lit('</id><name xml:lang="de">x</name><name>'), _escaped("p_name"), F.lit("</name><summary>"), _escaped("p_type"),
        F.lit('</summary><icon type="stock">s</icon><icon type="cached">'), k, F.lit('.png</icon><url type="bugtracker">y</url><url type="homepage">https://example.org/?a=1&amp;b='), k,
        F.lit('</url><releases><release version="'), F.col("p_size").cast("string"), F.lit('"/><release version="0"/></releases></component>'),
    )
    return xmlfeeds.parse_components(A.table(spark, d, "part").select(F.col("p_partkey").alias("key"), xml.alias("xml")), "xml")


@query("SELECT p_partkey AS key, CAST(p_size AS VARCHAR) AS name, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS summary, CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE CAST(p_size AS VARCHAR) END AS version, NULL AS homepage FROM part")
def primary_xml_round_trip(spark, d):
    size = F.col("p_size").cast("string")
    xml = F.concat(
        F.lit('<package type="rpm"><name>'), size, F.lit("</name>"), F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat(F.lit("<summary>"), _escaped("p_type"), F.lit("</summary>"))),
        F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.concat(F.lit('<version epoch="9" ver="'), size, F.lit('" rel="2"/>'))), F.lit("<url></url></package>"),
    )
    return xmlfeeds.parse_primary(A.table(spark, d, "part").select(F.col("p_partkey").alias("key"), xml.alias("xml")), "xml")


@query("SELECT page_id AS key, 'snap' || page_id AS name, CASE WHEN page_id % 2 = 0 THEN 'Snap ' || page_id ELSE 'snap' || page_id END AS title, '' AS summary, 'unknown' AS version, 'stable' AS channel, url AS iconUrl, CASE WHEN page_id % 3 = 0 THEN url END AS website FROM pages WHERE page_id % 7 <> 0")
def snap_feed_map(spark, d):
    p, i = A.table(spark, d, "pages"), F.col("page_id")
    name = F.when(i % 7 == 0, "").otherwise(F.concat(F.lit("snap"), i.cast("string")))
    media = F.array(F.struct(F.lit("banner").alias("type"), F.lit("b").alias("url")), F.struct(F.lit("icon").alias("type"), F.col("url")))
    snap = F.struct(F.when(i % 2 == 0, F.concat(F.lit("Snap "), i.cast("string"))).alias("title"), media.alias("media"), F.struct(F.when(i % 3 == 0, F.array("url")).alias("website")).alias("links"))
    feed = p.select(i.alias("key"), F.from_json(F.to_json(F.struct(name.alias("name"), snap.alias("snap"))), jsonfeeds.SNAP).alias("x"))
    return jsonfeeds.map_snaps(feed.select("key", "x.*"))


@query("SELECT page_id AS key, 'app' || page_id AS name, '' AS description, 'owner/' || page_id AS repo, NULL AS version, string_split(url, '/')[-1] AS iconFilename, 'https://github.com/owner/' || page_id AS homepage FROM pages WHERE page_id % 5 <> 0")
def appimage_feed_map(spark, d):
    p, i = A.table(spark, d, "pages"), F.col("page_id")
    repo = F.when(i % 5 != 0, F.concat(F.lit("owner/"), i.cast("string")))
    links = F.array(F.struct(F.lit("Download").alias("type"), F.lit("x").alias("url")), F.struct(F.lit("GitHub").alias("type"), repo.alias("url")), F.struct(F.lit("GitHub").alias("type"), F.lit("other/one").alias("url")))
    item = F.struct(F.concat(F.lit("app"), i.cast("string")).alias("name"), links.alias("links"), F.array("url").alias("icons"))
    return jsonfeeds.map_items(p.select(i.alias("key"), F.from_json(F.to_json(item), jsonfeeds.ITEM).alias("x")).select("key", "x.*"))


@query("SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS description, 'unknown' AS version, '' AS homepage FROM customer WHERE c_custkey % 9 <> 0")
def aur_dump_map(spark, d):
    c, k = A.table(spark, d, "customer"), F.col("c_custkey")
    row = F.struct(F.when(k % 9 != 0, F.col("c_name")).alias("Name"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("Description"), F.lit("").alias("URL"))
    return jsonfeeds.map_aur(c.select(k.alias("key"), F.from_json(F.to_json(row), jsonfeeds.AUR).alias("x")).select("key", "x.*"))


@query("SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages")
def html_title_extract(spark, d):
    return A.table(spark, d, "pages").select("page_id", X.empty_to_null(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query('SELECT r_regionkey, \'<data type="primary_db"><location href="no"/></data><data type="primary"><location href="repodata/\' || r_name || \'"/></data>\' AS repomd, \'repodata/\' || r_name AS location FROM region')
def repomd_location(spark, d):
    xml = F.concat(F.lit('<data type="primary_db"><location href="no"/></data><data type="primary"><location href="repodata/'), "r_name", F.lit('"/></data>'))
    return A.table(spark, d, "region").select("r_regionkey", xml.alias("repomd"), xmlfeeds.primary_location(xml).alias("location"))


FILLED = {"id": "id", "name": "name", "short_description": "shortDescription", "homepage": "nullif(home, '-')", "packages_json": "packages"}
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER"}
ROWS = ", ".join(f"{FILLED.get(n, 'NULL')}::{TYPES[k]} AS {n}" for n, k, _ in APPS)


@query(f"{CURATED} SELECT {ROWS} FROM apps")
def apps_table_rows(spark, d):
    return store.to_rows(E.enrich_texts(M.labelled(A.docs(spark, d))))


def _nullable(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} END"


@query(
    f"SELECT p_partkey AS id, {_nullable('p_partkey % 3 <> 0', 'CAST(p_partkey % 2 AS INT)')} AS ai_features, {_nullable('p_partkey % 4 <> 0', 'p_size / 10.0')} AS rating_average,"
    f" {_nullable('p_partkey % 4 <> 0', 'CAST(p_size AS BIGINT)')} AS rating_count, {_nullable('p_partkey % 4 <> 0', 'p_type')} AS age_rating_value,"
    " CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '[]' ELSE '[' || to_json(p_name) || ',' || to_json(p_brand) || ']' END AS languages_json,"
    " '[{\"stars\":' || p_size || ',\"text\":' || to_json(p_name) || '},{\"stars\":1}]' AS reviews_json FROM part"
)
def app_columns(spark, d):
    """Booleans as 1, 0 or null, nested fields, and lists as JSON texts."""
    k, none = F.col("p_partkey"), F.lit(None)
    apps = A.table(spark, d, "part").select(
        k.cast("string").alias("id"),
        F.when(k % 3 != 0, k % 2 == 1).alias("aiFeatures"),
        F.when(k % 4 != 0, F.struct((F.col("p_size") / 10.0).alias("average"), F.col("p_size").alias("count"))).alias("rating"),
        F.when(k % 4 != 0, F.struct(none.cast("string").alias("system"), F.col("p_type").alias("value"))).alias("ageRating"),
        F.when(k % 5 == 1, F.array().cast("array<string>")).when(k % 5 != 0, F.array("p_name", "p_brand")).alias("languages"),
        F.array(F.struct(F.col("p_size").alias("stars"), F.col("p_name").alias("text")), F.struct(F.lit(1).alias("stars"), none.cast("string").alias("text"))).alias("reviews"),
    )
    return store.to_rows(apps).select(F.col("id").cast("long").alias("id"), "ai_features", "rating_average", "rating_count", "age_rating_value", "languages_json", "reviews_json")


@query("SELECT 'nation' AS source, 'now' AS fetchedAt, count(*) AS entryCount, 'main,universe' AS component, 'core,extra' AS repos FROM nation")
def metadata_round_trip(spark, d):
    path = f"{shared_dir(spark)}/larkspur/nation-{uuid4().hex}.ndjson"
    n = A.table(spark, d, "nation").count()
    write_metadata(spark, path, {"source": "nation", "fetchedAt": "now", "url": path, "entryCount": n, "component": "main,universe", "repos": ["core", "extra"]})
    found = read_metadata(spark, path)
    return spark.createDataFrame([(found["source"], found["fetchedAt"], found["entryCount"], found["component"], ",".join(found["repos"]))], "source string, fetchedAt string, entryCount long, component string, repos string")


@query(f"WITH {A.PARTS} SELECT DISTINCT 'keep' AS list, source, name FROM pkgs_parts WHERE ordinal % 11 = 0 UNION ALL SELECT DISTINCT 'exclude', source, name FROM pkgs_parts WHERE ordinal % 13 = 0")
def filter_override_files(spark, d):
    """Override lists, entries of which occur again, through their files."""
    at, p = f"{shared_dir(spark)}/larkspur/overrides-{uuid4().hex}", A.parts(spark, d)
    for name, rows in zip(("keep", "exclude"), _overrides(spark, d), strict=True):
        write_ndjson(rows.select("source", "name", F.lit("r").alias("reason")).union(rows.select("source", "name", F.lit("again").alias("reason"))), f"{at}/{name}.ndjson")
    keep, exclude = load_filter_overrides(spark, f"{at}/keep.ndjson", f"{at}/exclude.ndjson")
    missing = load_filter_overrides(spark, f"{at}/none.ndjson", f"{at}/none.ndjson")[0]
    return keep.select(F.lit("keep").alias("list"), "*").union(exclude.select(F.lit("exclude").alias("list"), "*")).union(missing.select(F.lit("none").alias("list"), "*"))


@query(
    "SELECT 'manual' AS list, 'aur:' || n_name AS key_a, 'arch:' || n_nationkey AS key_b FROM nation"
    " UNION ALL SELECT DISTINCT 'deny', least('aur:' || n_name, 'arch:' || n_nationkey) || '|' || greatest('aur:' || n_name, 'arch:' || n_nationkey), NULL FROM nation"
)
def match_override_files(spark, d):
    at = f"{shared_dir(spark)}/larkspur/overrides-{uuid4().hex}"
    a = F.struct(F.lit("aur").alias("source"), F.col("n_name").alias("appId"))
    b = F.struct(F.lit("arch").alias("source"), F.col("n_nationkey").cast("string").alias("appId"))
    nation = A.table(spark, d, "nation")
    write_ndjson(nation.select(a.alias("a"), b.alias("b"), F.lit("r").alias("reason")), f"{at}/manual.ndjson")
    write_ndjson(nation.select(a.alias("a"), b.alias("b")).union(nation.select(b.alias("a"), a.alias("b"))), f"{at}/deny.ndjson")
    manual, deny = load_match_overrides(spark, f"{at}/manual.ndjson", f"{at}/deny.ndjson")
    return manual.select(F.lit("manual").alias("list"), "key_a", "key_b").union(deny.select(F.lit("deny"), "pair", F.lit(None).cast("string")))


@query("SELECT o_orderkey % 8 AS file, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS nth, 'order-' || o_orderkey AS name FROM orders")
def read_order_of_files(spark, d):
    """Rows of several files, in the files' order and each file's own."""
    at, orders = f"{shared_dir(spark)}/larkspur/orders-{uuid4().hex}", A.table(spark, d, "orders")
    name = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name")
    for k in range(8):
        part = orders.where(F.col("o_orderkey") % 8 == k).orderBy("o_orderkey").select(name).coalesce(1)
        part.write.json(f"{at}/part={k:02d}")
        move(spark, f"{at}/part={k:02d}", f"{at}/{k:02d}.json")
    found = read_ordered(spark, at, "name string")
    file = F.shiftright("line", PLACE_BITS).alias("file")
    return found.select(file, F.row_number().over(Window.partitionBy(file).orderBy("line")).cast("long").alias("nth"), "name")


@query(f"{CURATED} SELECT 'totalApps' AS key, CAST(count(*) AS VARCHAR) AS value FROM apps UNION ALL SELECT 'generatedAt', 'now' UNION ALL SELECT 'kept', 'yes'")
def meta_upsert(spark, d):
    apps = E.enrich(M.labelled(A.docs(spark, d)), False)
    old = spark.createDataFrame([("totalApps", "0"), ("kept", "yes")], "key string, value string")
    return store.upsert_meta(old, store.meta_rows(spark, "now", apps))


@query(f"{CURATED} SELECT label, id, name FROM apps ORDER BY label LIMIT 100")
def sample_prefix(spark, d):
    return store.sample(E.enrich(M.labelled(A.docs(spark, d)), False), 100).select("label", "id", "name")


@query(f"{CURATED} SELECT {ROWS} FROM apps")
def publish_swap(spark, d):
    apps = E.enrich_texts(M.labelled(A.docs(spark, d)))
    store.publish(apps, "now", "larkspur_apps", "larkspur_meta")
    return spark.table("larkspur_apps")
