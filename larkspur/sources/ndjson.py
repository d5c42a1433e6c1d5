"""Newline-delimited JSON caches with a metadata sidecar, and override files."""

from __future__ import annotations

import json
import re
from datetime import UTC, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pair_key, ref_key
from ..schema import FILTER_OVERRIDE, MATCH_OVERRIDE, METADATA, RANK_BITS, struct


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a file or folder of such files; none if it is missing. Blank lines are skipped, a malformed one raises when read."""
    if not exists(spark, path):
        return spark.createDataFrame([], struct(schema))
    return spark.read.schema(struct(schema)).option("mode", "FAILFAST").json(path)


PLACE_BITS = 36  # of a row's place in its file; the file's rank among those read is above


def numbered(rows: DataFrame) -> DataFrame:
    """Rows of files with `line`, which grows from file to file by name and along each: where its block starts, then its place in the block, with gaps."""
    files = sorted(unquote(f).rpartition("/")[2] for f in rows.inputFiles())
    if len(files) > 1 << (RANK_BITS - PLACE_BITS):
        raise ValueError(f"{len(files)} files of one source are too many to keep their order")
    ranks = rows.sparkSession.createDataFrame(list(enumerate(dict.fromkeys(files))), "_rank long, _file string")
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), place.alias("_place"))
    return placed.join(F.broadcast(ranks), "_file", "left").withColumn("line", F.shiftleft(F.coalesce("_rank", F.lit(0).cast("long")), PLACE_BITS) + F.col("_place")).drop("_file", "_place", "_rank")  # one row a file


def read_ordered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same with `line`, which gives the rows' order over all of the files."""
    if not exists(spark, path):
        return read_ndjson(spark, path, schema).withColumn("line", F.lit(0).cast("long"))
    return numbered(read_ndjson(spark, path, schema))


def write_ndjson(df: DataFrame, path: str, order: str | None = None) -> None:
    """One object a line; sorted by `order` into one file where given, else in parallel. Replaces what is there."""
    out = df.orderBy(order).drop(order).coalesce(1) if order else df
    out.write.mode("overwrite").json(path)


def move(spark: SparkSession, folder: str, path: str) -> None:
    """The single part file of a written folder to a path of its own."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = Path(folder)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in system.listStatus(at) if f.getPath().getName().startswith("part-"))
    system.rename(part, Path(path))
    system.delete(at, True)


def metadata_path(path: str) -> str:
    return re.sub(r"\.ndjson\Z", ".meta.json", path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file from the driver, through the session's own file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def now() -> str:
    return datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """The sidecar of a cache at `path`: indented JSON with a line break at its end."""
    write_text(spark, metadata_path(path), json.dumps(metadata, indent=2, ensure_ascii=False) + "\n")


def read_metadata(spark: SparkSession, path: str) -> dict | None:
    """The sidecar of a cache, None if there is none."""
    at = metadata_path(path)
    if not exists(spark, at):
        return None
    row = spark.read.schema(struct(METADATA)).option("multiLine", True).option("mode", "FAILFAST").json(at).first()
    return {k: v for k, v in row.asDict(recursive=True).items() if v is not None}


def load_filter_overrides(spark: SparkSession, keep: str, exclude: str) -> tuple[DataFrame, DataFrame]:
    """The (source, name) pairs to keep and to exclude, each once."""
    return tuple(read_ndjson(spark, p, FILTER_OVERRIDE).select("source", "name").distinct() for p in (keep, exclude))


def load_match_overrides(spark: SparkSession, manual: str, deny: str) -> tuple[DataFrame, DataFrame]:
    """(key_a, key_b) of the packages to link, and the `pair` keys of those not to."""
    forced = read_ndjson(spark, manual, MATCH_OVERRIDE).select(ref_key("a").alias("key_a"), ref_key("b").alias("key_b"))
    return forced, read_ndjson(spark, deny, MATCH_OVERRIDE).select(pair_key(ref_key("a"), ref_key("b")).alias("pair")).distinct()


def read_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines; blank ones and comments are skipped, the first = parts, the last of equal keys counts."""
    lines = (x.strip() for x in text.splitlines())
    return dict(x.split("=", 1) for x in lines if x and not x.startswith("#") and "=" in x)
