"""Raw files of all eight sources through caches to apps."""

import gzip
import io
import json
import os
import tarfile

import pytest
import zstandard
from pyspark.sql import functions as F

from larkspur.plans import cli
from larkspur.schema import CACHE, SOURCES
from larkspur.sinks import store
from larkspur.sources import ndjson, xmlfeeds
from larkspur.sources.landing import SNAP_CATEGORIES, refresh
from larkspur.sources.normalize import search_all
from larkspur.streaming.landing import refresh_available


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = data if isinstance(data, bytes) else data.encode()
    with open(path, "wb") as f:
        f.write(gzip.compress(data) if path.endswith(".gz") and not path.endswith(".tar.gz") else data)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    at = str(tmp_path_factory.mktemp("landing"))
    put(
        f"{at}/flathub/appstream.xml.gz",
        """<components><component type="desktop-application"><id>org.pad</id><name xml:lang="de">Block</name><name>Pad &amp; Co</name><summary>Writes</summary><icon type="stock">s</icon><icon type="cached">c.png</icon>
<url type="help">h</url><url type="homepage">https://pad</url><releases><release version="2"/><release version="1"/></releases></component>
<component type="runtime"><id>org.run</id><name>Run</name></component><component type="desktop"><id>org.no</id><name></name></component><component type="console-application"><id>org.bare</id><name xml:lang="en">Bare</name></component></components>""",
    )
    snap = lambda name, title: {"name": name, "revision": {"version": "3"}, "snap": {"title": title, "media": [{"type": "icon", "url": "https://x/i.png"}], "links": {"website": ["https://w"]}}}
    for c in SNAP_CATEGORIES:
        put(f"{at}/snapcraft/{c}.json", json.dumps({"results": [snap("draw", "Old"), {"name": ""}] if c == SNAP_CATEGORIES[0] else [{"name": "plain"}, snap("draw", "Draw")] if c == SNAP_CATEGORIES[1] else []}))
    put(f"{at}/appimage/feed.json", json.dumps({"items": [{"name": "Img", "links": [{"type": "GitHub", "url": "o/img"}], "icons": ["a/b.svg"]}, {"name": "No", "links": None}, {"name": "Two", "links": [{"type": "GitHub"}, {"type": "GitHub", "url": "x/y"}]}]}))
    put(f"{at}/aur/packages.json.gz", json.dumps([{"Name": "pad-co", "Description": None, "Version": None, "URL": ""}, {"Description": "no name"}]))
    deb = "Package: pad-co\r\nVersion: 1:2\r\nDescription: short\r\n long\r\nHomepage: \r\n\r\n\n\nVersion: 3\n\nPackage: libx1\nHomepage: https://x\n"
    put(f"{at}/debian/main/Packages.gz", deb)
    put(f"{at}/ubuntu/main/Packages.gz", "Package: first\n")
    put(f"{at}/ubuntu/universe/Packages.gz", "Package: second\nPackage: second2\n")
    put(f"{at}/fedora/repomd.xml", '<repomd><data type="primary_db"><location href="no"/></data><data type="primary"><checksum/><location href="repodata/p.xml.gz"/></data></repomd>')
    put(f"{at}/fedora/repodata/p.xml.gz", '<metadata><package type="rpm"><name>65535</name><version epoch="1" ver="2.0" rel="3"/><url></url></package><package type="rpm"><summary>none</summary></package></metadata>')
    for repo, text in (("core", "%NAME%\nzsh\nmore\n\n%VERSION%\n5\n\n%URL%\n\n%DESC%\nShell\n"), ("extra", "%DESC%\nno name\n")):
        data = io.BytesIO()
        with tarfile.open(fileobj=data, mode="w:gz") as tar:
            for name in (f"{repo}-1/desc", f"{repo}-1/files"):
                info = tarfile.TarInfo(name)
                info.size = len(text)
                tar.addfile(info, io.BytesIO(text.encode()))
        put(f"{at}/arch/{repo}.db.tar.gz", data.getvalue())
    return at


def test_refresh_and_build(spark, landing, tmp_path):
    caches = str(tmp_path / "caches")
    assert {s: refresh(spark, s, landing, caches) for s in SOURCES} == {"flathub": 2, "snapcraft": 2, "appimage": 1, "aur": 1, "debian": 2, "ubuntu": 2, "fedora": 1, "arch": 1}
    assert ndjson.read_metadata(spark, f"{caches}/appimage.ndjson")["totalFeedItems"] == 3
    found = [r.asDict() for r in search_all(spark, caches).orderBy("ordinal").collect()]
    names = [(r["source"], r["name"], r["appId"], r["version"], r["homepage"], r["iconFilename"]) for r in found]
    assert names == [
        ("flathub", "Pad & Co", "org.pad", "2", "https://pad", "c.png"), ("flathub", "Bare", "org.bare", "unknown", None, None),
        ("snapcraft", "Draw", "draw", "3", "https://w", "i.png"), ("snapcraft", "plain", "plain", "unknown", None, None),
        ("appimage", "Img", "o/img", "unknown", "https://github.com/o/img", "b.svg"), ("aur", "pad-co", "pad-co", "unknown", "", None),
        ("debian", "pad-co", "pad-co", "1:2", None, None), ("debian", "libx1", "libx1", "unknown", "https://x", None),
        ("ubuntu", "first", "first", "unknown", None, None), ("ubuntu", "second2", "second2", "unknown", None, None), ("fedora", "65535", "65535", "2.0", None, None), ("arch", "zsh", "zsh", "5", None, None),
    ]
    out = str(tmp_path / "out")
    assert cli.main(["build", "--caches", caches, "--overrides", str(tmp_path / "none"), "--out", out], spark) == 0
    text = "".join(r["value"] for p in sorted(x for x in os.listdir(f"{out}/dataset.json") if x.startswith("part-")) for r in spark.read.text(f"{out}/dataset.json/{p}").collect())
    whole = json.loads(text)
    assert whole["generatedAt"] == ndjson.read_metadata(spark, f"{out}/dataset.ndjson")["fetchedAt"] and [a["id"] for a in whole["apps"]][:2] == ["flathub:org.pad", "flathub:org.bare"]
    apps = {a["id"]: a for a in whole["apps"]}
    stamp, back = cli.read_dataset(spark, f"{out}/dataset.json")
    assert stamp == whole["generatedAt"] and back.columns == ["id", "name", "shortDescription", "homepage", "n_packages", "packages"] and back.count() == len(apps)
    assert "debian:libx1" not in apps and [p["source"] for p in apps["flathub:org.pad"]["packages"]] == ["flathub", "aur", "debian"]
    assert cli.main(["seed", "--caches", caches, "--out", out], spark) == 0
    assert {r["key"]: r["value"] for r in spark.table("meta").collect()}["totalApps"] == str(len(apps)) == str(spark.table("apps").count())
    published = {r["id"]: r for r in spark.table("apps").collect()}
    assert list(json.loads(published["flathub:org.pad"]["packages_json"])[0])[:4] == ["source", "name", "description", "version"]  # the fields' order
    put(str(tmp_path / "env"), "# tables\nPUBLISH_TABLE=other_apps\nPUBLISH_META=other_meta\n")
    build = ["--caches", caches, "--overrides", str(tmp_path / "none"), "--out", str(tmp_path / "out2"), "--settings", str(tmp_path / "env")]
    assert cli.main(["build", *build], spark) == 0 and spark.table("other_apps").count() == len(apps) and spark.table("other_meta").count() == 2
    assert cli.main(["seed", "--remote", *build], spark) == 0 and cli.main(["seed", "--remote", "--settings", str(tmp_path / "no"), "--out", out], spark) == 1
    assert cli.main(["sample", "--caches", caches, "--overrides", str(tmp_path / "none"), "--out", out], spark) == 0


def test_ndjson(spark, tmp_path):
    assert ndjson.read_ndjson(spark, str(tmp_path / "no"), CACHE["aur"]).count() == 0
    put(str(tmp_path / "x.ndjson"), '{"name":"a"}\n\n{"name":"b"}\n')
    assert [r["name"] for r in ndjson.read_ordered(spark, str(tmp_path / "x.ndjson"), CACHE["aur"]).orderBy("line").collect()] == ["a", "b"]
    put(str(tmp_path / "bad.ndjson"), "{oops\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        ndjson.read_ndjson(spark, str(tmp_path / "bad.ndjson"), CACHE["aur"]).collect()
    assert ndjson.metadata_path("a/x.ndjson") == "a/x.meta.json" and ndjson.read_metadata(spark, str(tmp_path / "x.ndjson")) is None
    assert ndjson.read_env("# c\nA=1=2\n\nA=3\nB= x ") == {"A": "3", "B": " x"}


def test_overrides(spark, tmp_path):
    put(str(tmp_path / "manual-matches.ndjson"), '{"a":{"source":"x","appId":"1"},"b":{"source":"y","appId":"2"},"reason":"r"}\n')
    put(str(tmp_path / "deny-matches.ndjson"), '{"a":{"source":"y","appId":"2"},"b":{"source":"x","appId":"1"},"reason":"r"}\n')
    manual, deny = ndjson.load_match_overrides(spark, str(tmp_path / "manual-matches.ndjson"), str(tmp_path / "deny-matches.ndjson"))
    assert manual.first()[:] == ("x:1", "y:2") and deny.first()[:] == ("x:1|y:2",)


def test_failed_publish_leaves_all(spark, monkeypatch):
    """A failure while tables change names, or in the rows, leaves apps and their metadata as they were."""
    rows = lambda name: spark.createDataFrame([(1, "a:1", name, "", None, [("aur", "x")])], "label long, id string, name string, shortDescription string, homepage string, packages array<struct<source string, name string>>")
    store.publish(rows("old"), "first", "p_apps", "p_meta")
    state = lambda: (spark.table("p_apps").select("name").collect(), sorted(spark.table("p_meta").collect()))
    before = state()
    real = store.has_table
    monkeypatch.setattr(store, "has_table", lambda s, t: real(s, t) if t != "p_meta" else (_ for _ in ()).throw(RuntimeError("store is gone")) if real(s, "p_meta_next") else True)
    with pytest.raises(RuntimeError, match="gone"):
        store.publish(rows("new"), "second", "p_apps", "p_meta")
    monkeypatch.undo()
    assert state() == before
    for bad in (rows("x").withColumn("name", F.lit(None).cast("string")), rows("x").union(rows("y"))):
        with pytest.raises(ValueError, match="null in name|not unique"):
            store.publish(bad, "third", "p_apps", "p_meta")
        assert state() == before
    store.publish(rows("new"), "fourth", "p_apps", "p_meta")
    assert state()[0][0]["name"] == "new" and {r["key"]: r["value"] for r in spark.table("p_meta").collect()} == {"generatedAt": "fourth", "totalApps": "1"}


def test_refresh_usage(spark, capsys):
    assert cli.main(["refresh"], spark) == 1 and cli.main(["refresh", "nix"], spark) == 1
    assert "usage" in capsys.readouterr().err


def test_zstd_and_icons(spark, tmp_path):
    xml = '<metadata><package type="rpm"><name>zed</name><version ver="1"/></package></metadata>'
    put(str(tmp_path / "p.xml.zst"), zstandard.ZstdCompressor().compress(xml.encode()))
    assert xmlfeeds.read_primary(spark, str(tmp_path / "p.xml.zst")).first()["name"] == "zed"
    icons = lambda *i: "".join(f'<icon{a}>{t}</icon>' for a, t in i)
    texts = [icons((' type="remote"', "r"), (' type="stock"', "s")), icons(("", "bare"), (' type="remote"', "r")), ""]
    rows = spark.createDataFrame([(i, f'<component type="desktop"><id>i{i}</id><name>n</name>{t}</component>') for i, t in enumerate(texts)], "key int, xml string")
    assert [r["iconFilename"] for r in xmlfeeds.parse_components(rows, "xml").orderBy("key").collect()] == ["s", "bare", None]


def test_order_of_files(spark, tmp_path):
    for k in range(8):
        put(str(tmp_path / f"x.ndjson/{k}.json"), "".join(f'{{"name":"{k:02d}-{i:05d}"}}\n' for i in range(2000)))
    rows = ndjson.read_ordered(spark, str(tmp_path / "x.ndjson"), CACHE["aur"]).select("line", "name").orderBy("line").collect()
    assert len({r["line"] for r in rows}) == 16_000 and [r["name"] for r in rows] == sorted(r["name"] for r in rows)


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown source"):
        refresh(spark, "nix", "a", "b")


def test_stream(spark, tmp_path):
    put(str(tmp_path / "in/a.json"), '{"name":"a"}\n{"name":""}\n')
    for _ in range(2):
        refresh_available(spark, str(tmp_path / "in"), CACHE["aur"], str(tmp_path / "out"), str(tmp_path / "cp"), lambda df: df.where("name <> ''")).awaitTermination()
    assert [r["name"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]
