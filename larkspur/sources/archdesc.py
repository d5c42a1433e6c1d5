"""Package descriptions (`desc` files in a tar archive) of Arch repositories."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, filled
from ..schema import UNKNOWN_VERSION


def field(content: Column | str, key: str) -> Column:
    """The first value line of the last block headed %key%. Null: none."""
    blocks = F.transform(F.split(content, "\\n\\n+"), lambda b: F.filter(F.split(b, "\\n"), lambda x: x != ""))
    return F.get(F.try_element_at(F.filter(blocks, lambda b: (F.get(b, F.lit(0)) == f"%{key}%") & (F.size(b) > 1)), F.lit(-1)), F.lit(1))


def map_desc(texts: DataFrame, repo: str, column: str = "content") -> DataFrame:
    """Texts to cache rows; without a name they are dropped."""
    others = [c for c in texts.columns if c != column]
    rows = texts.select(*others, *(field(column, k).alias(f"_{k}") for k in ("NAME", "DESC", "VERSION", "URL"))).where(filled("_NAME"))
    return rows.select(
        *others, F.col("_NAME").alias("name"), F.coalesce("_DESC", F.lit("")).alias("description"), F.coalesce("_VERSION", F.lit(UNKNOWN_VERSION)).alias("version"),
        empty_to_null("_URL").alias("homepage"), F.lit(repo).alias("repo"),
    )


def read_desc(spark: SparkSession, path: str) -> DataFrame:
    """The desc files of tar archives, compressed or not: (member number, content). Folders without one give none."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                    for k, member in enumerate(tar):
                        if member.isfile() and member.name.rstrip("/").endswith("/desc"):
                            yield pa.RecordBatch.from_pydict({"line": pa.array([k], pa.int64()), "content": [tar.extractfile(member).read().decode("utf-8", "replace")]})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(unpack, "line long, content string")


def read_repos(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Archives by repository, in that order."""
    out = None
    for rank, (repo, path) in enumerate(paths.items()):
        rows = map_desc(read_desc(spark, path), repo).withColumn("line", F.col("line") + F.lit(rank << 40))
        out = rows if out is None else out.unionByName(rows)
    return out
