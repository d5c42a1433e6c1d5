"""Shared plumbing of the training-data operators: bounded Arrow batches and column checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..tables import discard, shared_dir, written  # noqa: F401

#: Rows and bytes that one Arrow batch holds at most, so that a Python worker's memory does not follow the partition size.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[list]]], schema: str) -> DataFrame:
    """Rows of df through a Python function, batch by batch.

    make() runs once in each task and returns a function from a record batch to lists of columns, in the order of schema.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds: StructType = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        last = getattr(work, "finish", None)
        if last:
            for columns in last():
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    plain = [c if c.isidentifier() else f"_larkspur_{k}" for k, c in enumerate(df.columns)]  # mapInArrow looks columns up by name, and a dot parts names
    return (df if plain == df.columns else df.toDF(*plain)).mapInArrow(run, kinds)


def need(df: DataFrame, *columns: str) -> DataFrame:
    """df cut to columns; a clear error where one is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are: {', '.join(df.columns)}")
    return df.select(*columns)
