"""Relations: packages, the eight sources' cache rows, groups, apps and the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: The sources in the order in which their packages are united, and those preferred for display.
SOURCES = ("flathub", "snapcraft", "appimage", "aur", "debian", "ubuntu", "fedora", "arch")
PREFERRED = ("flathub", "snapcraft", "appimage")
UNKNOWN_VERSION = "unknown"
RANK_BITS = 48  # an ordinal is the source's rank, then the row's place in its cache

PACKAGE = "ordinal long, source string, name string, description string, version string, appId string, channel string, iconFilename string, homepage string, arch string, lastUpdated string"
#: The order of a package's fields in JSON.
PACKAGE_FIELDS = ("source", "name", "description", "version", "appId", "channel", "iconFilename", "homepage", "arch", "lastUpdated")

CACHE = {
    "flathub": "id string, name string, summary string, version string, iconFilename string, homepage string",
    "snapcraft": "name string, title string, summary string, version string, channel string, iconUrl string, website string",
    "appimage": "name string, description string, repo string, version string, iconFilename string, homepage string",
    "aur": "name string, description string, version string, homepage string",
    "debian": "name string, description string, version string, homepage string, component string",
    "ubuntu": "name string, description string, version string, homepage string, component string",
    "fedora": "name string, summary string, version string, homepage string",
    "arch": "name string, description string, version string, homepage string, repo string",
}
FILTER_OVERRIDE = "source string, name string, reason string"
MATCH_OVERRIDE = "a struct<source string, appId string>, b struct<source string, appId string>, reason string"
METADATA = "source string, fetchedAt string, url string, entryCount long, arch string, deviceSeries string, categoriesSwept array<string>, totalFeedItems long, suite string, component string, release string, repos array<string>"

#: Columns of the published table `apps`: name, type, and the app's field or expression over it.
APPS = (
    ("id", "string", "id"), ("name", "string", "name"), ("short_description", "string", "shortDescription"), ("long_description", "string", "longDescription"),
    ("homepage", "string", "homepage"), ("category", "string", "category"), ("developer", "string", "developer"), ("publisher", "string", "publisher"), ("license", "string", "license"),
    ("icon_url", "string", "iconUrl"), ("approx_size_bytes", "bigint", "approxSizeBytes"), ("changelog", "string", "changelog"), ("requirements", "string", "requirements"),
    ("rating_average", "double", "rating.average"), ("rating_count", "bigint", "rating.count"), ("ai_features", "int", "aiFeatures"), ("in_app_purchases", "int", "inAppPurchases"), ("gdpr_compliant", "int", "gdprCompliant"),
    ("age_rating_system", "string", "ageRating.system"), ("age_rating_value", "string", "ageRating.value"), ("languages_json", "string", "languages"), ("screenshots_json", "string", "screenshots"), ("videos_json", "string", "videos"),
    ("reviews_json", "string", "reviews"), ("features_json", "string", "features"), ("permissions_json", "string", "permissions"), ("editorial_tags_json", "string", "editorialTags"), ("packages_json", "string", "packages"),
)
META = "key string, value string"
#: An app as the dataset file has it.
APP = f"id string, name string, shortDescription string, homepage string, n_packages long, packages array<struct<{', '.join(f'{f}: string' for f in PACKAGE_FIELDS)}>>"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
