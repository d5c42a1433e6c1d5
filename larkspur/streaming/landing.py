"""Refreshing caches from a landing folder as files arrive: an addition, since sources are otherwise read in batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schema import struct


def refresh_available(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Appends what parse() makes of the JSON files that have arrived since the last call to a Parquet folder, each file once, and stops.

    parse() has to be a projection or a filter, with no state between files.
    """
    rows = spark.readStream.schema(struct(schema)).option("mode", "FAILFAST").json(landing)
    return parse(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
