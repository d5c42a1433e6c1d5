"""Grouping against a plain sequential union-find."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.operators import enrich, matching
from larkspur.operators.components import components
from larkspur.operators.filtering import filter_packages
from larkspur.plans.curation import Overrides, build_apps
from larkspur.schema import PACKAGE, struct
from larkspur.sinks import store


def packages(spark, rows):
    """rows of (source, name, appId[, description, homepage])"""
    full = [(i, r[0], r[1], r[3] if len(r) > 3 else "", "1", r[2], None, None, r[4] if len(r) > 4 else None, None, None) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, struct(PACKAGE))


def key(r):
    return f"{r[0]}:{r[1] if r[2] is None else r[2]}"


def by_hand(rows, manual, deny):
    """Groups as lists of row numbers, in order."""
    at = {}

    def find(x):
        at.setdefault(x, x)
        while at[x] != x:
            x = at[x]
        return x

    for a, b in manual:
        at[find(a)] = find(b)
    for value in (lambda r: r[2], lambda r: "".join(c for c in r[1].lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789")):
        first = {}
        for r in rows:
            if v := value(r):
                if v not in first:
                    first[v] = key(r)
                elif "|".join(sorted((key(r), first[v]))) not in deny:
                    at[find(key(r))] = find(first[v])
    out = {}
    for i, r in enumerate(rows):
        out.setdefault(find(key(r)), []).append(i)
    return sorted(out.values())


def groups(spark, rows, manual=(), deny=()):
    tables = spark.createDataFrame(list(manual), "key_a string, key_b string"), spark.createDataFrame([(d,) for d in deny], "pair string")
    found = matching.group_packages(packages(spark, rows), *tables).orderBy("label").collect()
    assert [r["id"] for r in found] == [key(rows[r["packages"][0]["ordinal"]]) for r in found]
    return [[p["ordinal"] for p in r["packages"]] for r in found]


def test_tiers_and_unrelated(spark):
    assert groups(spark, [("flathub", "One", "org.x"), ("snapcraft", "Uno", "org.x"), ("aur", "toolx", None), ("flathub", "Tool-X", "q"), ("arch", "else", "w")]) == [[0, 1], [2, 3], [4]]


def test_empty_ids_and_names(spark):
    rows = [("aur", "a", ""), ("aur", "b", ""), ("arch", "日", None), ("arch", "本", None)]
    assert groups(spark, rows) == by_hand(rows, [], set()) == [[0, 1], [2], [3]]


def test_ghost_bridge_and_deny(spark):
    rows = [("flathub", "A", "a"), ("arch", "B", "b"), ("aur", "A", "x")]
    assert groups(spark, rows, [("flathub:a", "no:ghost"), ("no:ghost", "arch:b")]) == [[0, 1, 2]]
    assert groups(spark, rows, [], ["aur:x|flathub:a"]) == [[0], [1], [2]]


def test_random_cases(spark):
    random.seed(5)
    for _ in range(6):
        rows = [(random.choice(("flathub", "aur", "arch")), random.choice("abcdef") + random.choice(("", "-", "é")), random.choice((None, "", "p", "q", "r", "s"))) for _ in range(14)]
        keys = sorted({key(r) for r in rows}) + ["ghost:1"]
        manual = [tuple(random.sample(keys, 2)) for _ in range(2)]
        deny = {"|".join(sorted(random.sample(keys, 2))) for _ in range(4)}
        assert groups(spark, rows, manual, deny) == by_hand(rows, manual, deny)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    at = {x: x for e in edges for x in e}
    for _ in range(40):
        for a, b in edges:
            at[a] = at[b] = min(at[a], at[b])
    found = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: c for x, c in at.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_long_path(spark):
    found = components(spark.range(300).selectExpr("id as u", "id + 1 as v")).collect()
    assert {r["component"] for r in found} == {0} and len(found) == 301


def test_filter_order(spark):
    p = packages(spark, [("debian", "x-dev", None), ("debian", "y", None), ("debian", "z-dev", None), ("aur", "y", None)])
    keep = spark.createDataFrame([("debian", "x-dev"), ("debian", "q")], "source string, name string")
    out = spark.createDataFrame([("debian", "y"), ("debian", "x-dev")], "source string, name string")
    assert sorted(r["ordinal"] for r in filter_packages(p, keep, out).collect()) == [0, 3]


def test_enrich(spark):
    p = packages(spark, [("aur", "Tool", "t1", "aur text", "https://a"), ("flathub", "Tool", "t2", "", None), ("appimage", "tool", "t3", "image text", "https://c")])
    row = build_apps(p).first()
    assert (row["id"], row["name"], row["shortDescription"], row["homepage"], [x["source"] for x in row["packages"]]) == ("aur:t1", "Tool", "image text", None, ["aur", "flathub", "appimage"])
    assert enrich.enrich(matching.labelled(packages(spark, [("aur", "x", None, "")]))).first()["shortDescription"] == ""


def test_empty(spark):
    assert build_apps(packages(spark, []), Overrides()).count() == 0


@pytest.mark.parametrize("share", [1, 1000])
def test_enrich_texts(spark, monkeypatch, share):
    """The same apps as enrich(), members as JSON text: of groups of one, two and many, gathered apart or with the others."""
    rows = [("aur", f"t{i}", f"tool {max(0, i - 4) if i < 6 else 9}", f'text "{i}"\n' if i % 2 else None) for i in range(40)]
    monkeypatch.setattr(enrich, "SHARE", share)
    p = matching.labelled(packages(spark, rows)).withColumn("homepage", F.when(F.col("ordinal") % 3 == 0, "https://x"))
    want = enrich.enrich(p).withColumn("packages", F.to_json("packages"))
    found = enrich.enrich_texts(p)
    assert found.columns == want.columns and sorted(found.collect()) == sorted(want.collect()) and len({r["n_packages"] for r in want.collect()}) > 2
    assert store.to_rows(found).select("packages_json").where("packages_json like '[{%}]'").count() == want.count()
