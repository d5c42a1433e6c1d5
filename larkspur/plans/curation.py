"""From packages to apps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import enrich
from ..operators.filtering import filter_packages
from ..operators.matching import labelled
from ..sources.ndjson import load_filter_overrides, load_match_overrides


@dataclass
class Overrides:
    """Hand-made tables: keep and exclude (source, name), manual (key_a, key_b), deny (pair)."""

    keep: DataFrame | None = None
    exclude: DataFrame | None = None
    manual: DataFrame | None = None
    deny: DataFrame | None = None

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Overrides:
        """From the four files of a folder; missing ones count as empty."""
        keep, exclude = load_filter_overrides(spark, f"{folder}/filter-keep.ndjson", f"{folder}/filter-exclude.ndjson")
        return cls(keep, exclude, *load_match_overrides(spark, f"{folder}/manual-matches.ndjson", f"{folder}/deny-matches.ndjson"))


def build_apps(packages: DataFrame, overrides: Overrides | None = None, members: bool = True) -> DataFrame:
    """packages to apps, one for each group, in the order of label: filter, group, enrich. members: with the packages of each."""
    o = overrides or Overrides()
    return enrich(labelled(filter_packages(packages, o.keep, o.exclude), o.manual, o.deny), members)
