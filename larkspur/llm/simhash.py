"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is the majority vote of the XXH64 values of a text's word shingles. Two fingerprints link where they differ
in at most `radius` bits. Covering hashing finds every such pair: each bit position i has a vector m(i) of radius + 1 bits,
and each of the 2^(radius + 1) - 1 non-zero vectors v makes one table, keyed by the bits at the positions with <m(i), v> = 1.
At most radius differing positions span at most radius dimensions, so some v is orthogonal to all of their vectors: its
mask holds none of these positions, and in its table both keys are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..operators.joins import join_counted
from .common import map_rows, need, written

WORDS_AT_ONCE = 1 << 16
LAST = (1 << 63) - 1  # stands for the id of documents that have none
#: Rows of a bucket up to which its pairs are compared directly; larger buckets go the linear way of _by_balls.
SMALL_BUCKET = 24


def fingerprint(text: str | None, size: int = 3) -> int:
    """The fingerprint of one text, unsigned. Null and wordless texts: 0; fewer than `size` words: one shingle of them all."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only space and 9 to 13 separate
    if not words:
        return 0
    n, ones = max(1, len(words) - size + 1), np.zeros(64, np.int64)
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE + size - 1]
        rows = zip(*(part[k:] for k in range(size)), strict=False) if len(words) >= size else [words]
        h = np.fromiter(map(lambda s: xxh64_intdigest(s, 42), map(b" ".join, rows)), np.uint64)
        for k in range(0, len(h), 4096):
            ones += np.unpackbits(h[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """docs (doc_id, text) to (doc_id, fp): fp is the fingerprint as a signed long. Every row gives one row."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            found = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
            yield [batch.column(0), found.view(np.int64)]

        return work

    return map_rows(need(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), make, "doc_id long, fp long")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The 2^(radius + 1) - 1 masks, as signed longs. Position i has the vector (i mod all non-zero vectors) + 1, so masks hold about half of the positions."""
    full = (1 << (radius + 1)) - 1
    masks = [sum(1 << i for i in range(bits) if ((i % full + 1) & v).bit_count() & 1) for v in range(1, full + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _by_balls(points: DataFrame, radius: int) -> DataFrame:
    """Links among many fingerprints in one bucket, without their pairs.

    Two of them are within 2 of each other exactly where a third point is within 1 of both. Each emits the 65 points
    within 1; all that meet in a point link to the smallest there, so a group of n costs 65 n rows and is as connected.
    """
    if radius != 2:
        raise ValueError("large buckets need radius 2")
    flips = F.array(F.lit(0).cast("long"), *(F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k).cast("long") for k in range(64)))
    met = points.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("z")).groupBy("z").agg(F.collect_set("fp").alias("all"))  # 65 at most
    return met.where("size(all) > 1").select(F.explode("all").alias("u"), F.array_min("all").alias("v")).where("u <> v")


def links(points: DataFrame, radius: int = 2, small: int = SMALL_BUCKET) -> DataFrame:
    """Distinct fingerprints (fp) to links (u, v) that connect exactly those within `radius` of each other, copies aside.

    Tables' buckets of up to `small` rows are compared pair by pair; the members of larger ones link through shared points.
    """
    tables = points.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in covering_masks(radius)))).alias("t", "key"))
    sizes = tables.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    held = tables.join(sizes, ["t", "key"])
    few = held.where(F.col("n") <= small).groupBy("t", "key").agg(F.collect_list("fp").alias("all"))
    pairs = few.select(F.explode("all").alias("u"), "all").select("u", F.explode("all").alias("v")).where(F.col("u") < F.col("v")).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    crowd = held.where(F.col("n") > small).select("fp").distinct()
    return pairs.union(_by_balls(crowd, radius)).distinct()


def near_duplicates(docs: DataFrame, radius: int = 2, size: int = 3) -> DataFrame:
    """docs (doc_id, text) to (doc_id, fp, component_id): component_id is the smallest doc_id that links reach.

    Null or wordless texts have fingerprint 0 and link like any other. Rows with a null doc_id come out too, in the component
    of their fingerprint, but never name one (a component of such rows alone has a null id). Repeated rows come out as often
    as they came in. An empty table gives an empty one. Other columns of docs do not matter.
    """
    prints = written(fingerprints(docs, size), "fingerprints")
    points = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "points")
    # a vertex is a fingerprint by its smallest id, so that the smallest vertex of a component has the id that names it; without ids it is the last
    vertex = F.struct(F.coalesce("least", F.lit(LAST)).alias("least"), "fp")
    ends = links(points.select("fp"), radius)
    for end in "uv":
        ends = ends.join(points.select(F.col("fp").alias(end), vertex.alias(f"{end}_")), end)
    groups = written(components(ends.select(F.col("u_").alias("u"), F.col("v_").alias("v"))), "groups")
    found = groups.select("vertex.fp", F.nullif("component.least", F.lit(LAST)).alias("component_id"), F.lit(True).alias("linked"))
    named = points.join(found, "fp", "left").select("fp", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    named = written(named, "named")
    return join_counted(prints, named, "fp", "n")


def keep_first(docs: DataFrame, radius: int = 2, size: int = 3) -> DataFrame:
    """docs with one document of each component, that of the smallest doc_id. Rows with a null doc_id, and repeated rows with that id, stay.

    Null and wordless texts are copies of one another. Columns of any name stay as they are. An empty table gives an empty one.
    """
    gone = near_duplicates(docs, radius, size).where("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """A row for each document, null and wordless texts too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
