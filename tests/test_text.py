from pyspark.sql import functions as F

from larkspur.functions import text as X


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


def test_normalize_name(spark):
    assert one(spark, X.normalize_name("x"), x="Café-Tool 2") == "caftool2"
    assert one(spark, X.normalize_name("x"), x="日本") == ""


def test_support_packages(spark):
    names = {"foo-dev": True, "foo-docs": True, "foo-dev\n": False, "libfoo3": True, "libreoffice": False, "fonts-x": True, "ttf-y": True, "gimp": False, "foo-devel": False}
    rows = spark.createDataFrame([(n,) for n in names], "name string").select("name", X.looks_like_support_package("name").alias("x")).collect()
    assert {r["name"]: r["x"] for r in rows} == names


def test_keys(spark):
    assert one(spark, X.package_key(), source="aur", appId=None, name="n") == "aur:n"
    assert one(spark, X.package_key(), source="aur", appId="", name="n") == "aur:"
    assert one(spark, X.pair_key("a", "b"), a="z", b="c") == "c|z" == one(spark, X.pair_key("a", "b"), a="c", b="z")


def test_segments_and_space(spark):
    assert one(spark, X.last_segment("x"), x="https://a/b.png") == "b.png"
    assert one(spark, X.last_segment("x"), x="a/") == ""
    assert one(spark, X.trim_space("x"), x="﻿\t  a b \r\n") == "a b"
    assert one(spark, X.empty_to_null("x"), x="") is None


def test_similarity(spark):
    assert one(spark, X.levenshtein_similarity("a", "b"), a="", b="") == 1.0
    assert one(spark, X.levenshtein_distance("a", "b"), a="Kitten", b="sITTING") == 3
    assert one(spark, X.utf16_length("a"), a="😀a") == 3
    df = spark.createDataFrame([(("Tool", "id", "i.png"), ("Tool", "id", "i.png"), ("Tool", None, None))], "a struct<name string, appId string, iconFilename string>, b struct<name string, appId string, iconFilename string>, c struct<name string, appId string, iconFilename string>")
    assert df.select(F.round(X.score_match("a", "b"), 9), F.round(X.score_match("a", "c"), 9)).first()[:] == (1.0, 0.5)
