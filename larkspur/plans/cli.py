"""Command line: refresh sources from a landing folder, build the apps, write a sample, publish."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import APP, SOURCES, struct
from ..sinks.store import SAMPLE, publish, sample
from ..sources.landing import refresh
from ..sources.ndjson import exists, now, read_env, write_metadata
from ..sources.normalize import search_all
from .curation import Overrides, build_apps

EVERY = "all"


def write_dataset(apps: DataFrame, path: str, stamp: str) -> None:
    """Apps in the order of label as one JSON document, {generatedAt, apps}: a folder of texts that are it one after another, a line for each app.

    Spark sorts by ranges, so that many tasks write it.
    """
    spark = apps.sparkSession
    first = apps.agg(F.min("label")).scalar()
    line = F.concat(F.when(F.col("label") == first, "").otherwise(","), F.to_json(F.struct(*(f.name for f in struct(APP)))))
    ends = spark.createDataFrame([(0, 0, f'{{"generatedAt":"{stamp}","apps":['), (2, 0, "]}")], "part int, label long, value string")
    whole = apps.select(F.lit(1).alias("part"), F.col("label").cast("long"), line.alias("value")).union(ends)
    whole.orderBy("part", "label").select("value").write.mode("overwrite").text(path)


def read_dataset(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """When a dataset was written, and its apps, with every field of APP whether any app has it or not."""
    lines = spark.read.text(path)
    head = F.from_json(F.concat("value", F.lit("]}")), "generatedAt string")["generatedAt"]
    stamp = lines.where(F.col("value").startswith('{"generatedAt":')).select(head).first()[0]
    apps = lines.where(~F.col("value").startswith('{"generatedAt":') & (F.col("value") != "]}"))
    return stamp, apps.select(F.from_json(F.regexp_replace("value", "^,", ""), struct(APP), {"mode": "FAILFAST"}).alias("x")).select("x.*")


def settings(spark: SparkSession, path: str) -> dict[str, str]:
    """What the shared settings file says; a missing file says nothing."""
    return read_env(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else {}


def build(spark: SparkSession, caches: str, overrides: str, out: str, target: dict[str, str] | None = None) -> str:
    """Writes the apps to {out}/dataset.json with a sidecar, and publishes them where target names a table; gives the time that they bear."""
    stamp, path = now(), f"{out}/dataset.json"
    write_dataset(build_apps(search_all(spark, caches), Overrides.load(spark, overrides)), path, stamp)
    apps = read_dataset(spark, path)[1]
    write_metadata(spark, f"{out}/dataset.ndjson", {"source": "apps", "fetchedAt": stamp, "url": caches, "entryCount": apps.count()})
    if (target or {}).get("PUBLISH_TABLE"):
        publish(apps, stamp, target["PUBLISH_TABLE"], target.get("PUBLISH_META", "meta"))
    return stamp


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    top = argparse.ArgumentParser(prog="larkspur")
    todo = top.add_subparsers(dest="command", required=True)
    for name in ("refresh", "build", "sample", "seed"):
        sub = todo.add_parser(name)
        sub.add_argument("--caches", default="caches")
        if name in ("refresh", "seed"):
            sub.add_argument("--landing", default="landing")
        if name == "refresh":
            sub.add_argument("sources", nargs="*", help=f"{', '.join(SOURCES)}, or {EVERY}")
            continue
        sub.add_argument("--overrides", default="overrides")
        sub.add_argument("--out", default="dist")
        sub.add_argument("--force", action="store_true")
        sub.add_argument("--settings", default=".env", help="KEY=VALUE lines; PUBLISH_TABLE and PUBLISH_META name the published tables")
        if name == "seed":
            sub.add_argument("--remote", action="store_true", help="publish to the tables that the settings name, not to apps and meta")
    a = top.parse_args(arguments)
    if a.command == "refresh" and (not a.sources or {*a.sources} - {*SOURCES, EVERY}):
        print(f"usage: refresh <{' | '.join((*SOURCES, EVERY))}> ...", file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.appName("larkspur").getOrCreate()
    if a.command == "refresh" or a.command == "seed" and a.force:
        asked = getattr(a, "sources", [EVERY])
        for source in SOURCES if EVERY in asked else asked:
            print(f"{source}: {refresh(spark, source, a.landing, a.caches)}", file=sys.stderr)
    if a.command == "build":
        build(spark, a.caches, a.overrides, a.out, settings(spark, a.settings))
    if a.command == "sample":
        found = sample(build_apps(search_all(spark, a.caches), Overrides.load(spark, a.overrides)), SAMPLE)
        found.coalesce(1).write.mode("overwrite").json(f"{a.out}/sample.ndjson")
    if a.command == "seed":
        target = settings(spark, a.settings) if a.remote else {"PUBLISH_TABLE": "apps"}
        if not target.get("PUBLISH_TABLE"):
            print(f"{a.settings} names no PUBLISH_TABLE", file=sys.stderr)
            return 1
        if a.force or not exists(spark, f"{a.out}/dataset.json"):
            build(spark, a.caches, a.overrides, a.out)
        stamp, apps = read_dataset(spark, f"{a.out}/dataset.json")
        publish(apps, stamp, target["PUBLISH_TABLE"], target.get("PUBLISH_META", "meta"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
