"""Control stanzas (deb822) of Debian and Ubuntu package lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, filled, trim_space
from ..schema import UNKNOWN_VERSION

WANTED = ("Package", "Version", "Description", "Homepage")


def stanzas(text: DataFrame, column: str = "text") -> DataFrame:
    """Texts to their stanzas, parted by blank lines: the other columns, `position` from 0 and `stanza`."""
    others = [c for c in text.columns if c != column]
    return text.select(*others, F.posexplode(F.split(F.col(column), "\\r?\\n\\r?\\n+")).alias("position", "stanza")).where(F.trim("stanza") != "")


def field(stanza: Column | str, key: str) -> Column:
    """The value of the last line `key: value`; lines that start with white space continue another field and do not count. Null: none."""
    lines = F.filter(F.split(stanza, "\\r?\\n"), lambda x: x.startswith(f"{key}:"))
    return trim_space(F.substr(F.try_element_at(lines, F.lit(-1)), F.lit(len(key) + 2)))


def parse_packages(text: DataFrame, component: str, column: str = "text") -> DataFrame:
    """Texts to cache rows in order: name, description, version, homepage, component; stanzas without a package name are dropped."""
    rows = stanzas(text, column)
    rows = rows.select(*[c for c in rows.columns if c != "stanza"], *(field("stanza", k).alias(k.lower()) for k in WANTED)).where(filled("package"))
    kept = [c for c in rows.columns if c not in {k.lower() for k in WANTED}]
    return rows.select(
        *kept, F.col("package").alias("name"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("version", F.lit(UNKNOWN_VERSION)).alias("version"),
        empty_to_null("homepage").alias("homepage"), F.lit(component).alias("component"),
    )


def read_packages(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Package files by component, in that order. Compressed ones are read by their ending."""
    out = None
    for rank, (component, path) in enumerate(paths.items()):
        text = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
        rows = parse_packages(text, component).withColumn("line", F.col("position") + F.lit(rank << 40)).drop("position")
        out = rows if out is None else out.unionByName(rows)
    return out
