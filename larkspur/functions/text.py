"""Column functions over package names, keys and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What tells a support package by its name, anchored at the very end of the input.
SUPPORT = (r"-(dev|dbg|dbgsym|docs?)\z", r"^lib[\w.+-]*\d\z", r"^(ttf|fonts|otf)-")
#: Weights of a match of two packages.
WEIGHT_NAME, WEIGHT_APP_ID, WEIGHT_ICON = 0.5, 0.35, 0.15
_SPACE = r"[\s\x0B\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"  # JavaScript's white space


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_name(name: Column | str) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(_c(name)), "[^a-z0-9]", "")


def trim_space(x: Column | str) -> Column:
    """Without any Unicode white space at the ends, line breaks, no-break spaces and byte-order marks included."""
    return F.regexp_replace(_c(x), rf"^{_SPACE}|{_SPACE}\z", "")


def last_segment(path: Column | str) -> Column:
    """What follows the last slash; empty after a trailing one."""
    return F.element_at(F.split(_c(path), "/", -1), -1)


def filled(x: Column | str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(_c(x) != "", F.lit(False))


def empty_to_null(x: Column | str) -> Column:
    return F.nullif(_c(x), F.lit(""))


def looks_like_support_package(name: Column | str) -> Column:
    name = _c(name)
    return name.rlike(SUPPORT[0]) | name.rlike(SUPPORT[1]) | name.rlike(SUPPORT[2])


def package_key(source: Column | str = "source", app_id: Column | str = "appId", name: Column | str = "name") -> Column:
    """source:appId; the name stands in for a null id, not for an empty one."""
    return F.concat(_c(source), F.lit(":"), F.coalesce(_c(app_id), _c(name)))


def ref_key(ref: Column | str) -> Column:
    return F.concat(_c(ref)["source"], F.lit(":"), _c(ref)["appId"])


def pair_key(a: Column | str, b: Column | str) -> Column:
    """The same for either order."""
    return F.concat(F.least(_c(a), _c(b)), F.lit("|"), F.greatest(_c(a), _c(b)))


def utf16_length(x: Column | str) -> Column:
    return (F.octet_length(F.encode(_c(x), "UTF-16BE")) / 2).cast("int")


def levenshtein_distance(a: Column | str, b: Column | str) -> Column:
    """Case-insensitive. Counts code points; texts outside the basic plane count those characters once."""
    return F.levenshtein(F.lower(_c(a)), F.lower(_c(b)))


def levenshtein_similarity(a: Column | str, b: Column | str) -> Column:
    """1 - distance / length of the longer as written; 1 for two empty texts."""
    longer = F.greatest(utf16_length(a), utf16_length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - levenshtein_distance(a, b) / longer)


def score_match(a: str = "a", b: str = "b") -> Column:
    """How alike two package structs are, from 0 to 1."""
    x, y = F.col(a), F.col(b)

    def same(field: str) -> Column:
        return F.when(filled(x[field]) & (x[field] == y[field]), 1.0).otherwise(0.0)

    return levenshtein_similarity(x["name"], y["name"]) * WEIGHT_NAME + same("appId") * WEIGHT_APP_ID + same("iconFilename") * WEIGHT_ICON
