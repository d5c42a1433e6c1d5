"""Transport streams and archives: exact round trips, damage, and the contracts' columns by brute force."""

import hashlib
import random
import zlib
from base64 import b32encode

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.llm import arc, mpegts


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=6000), st.integers(1, 2000), st.integers(1, 5))
def test_ts_round_trip(payload, unit, every):
    stream = mpegts.mux(payload, unit, every)
    s = mpegts.demux(stream)
    assert len(stream) % 188 == 0 and s.payload() == payload and (s.cc_errors, s.crc_errors, s.sync_errors, s.duplicates) == (0, 0, 0, 0)
    assert s.programs == {1: mpegts.PMT_PID} and s.streams == {mpegts.ES_PID: 6}
    assert [u.pts for u in s.units] == [3600 * k for k in range(len(s.units))] and [u.random_access for u in s.units] == [k % every == 0 for k in range(len(s.units))]


def test_ts_damage():
    stream = mpegts.mux(bytes(range(256)) * 40)
    packets = [stream[i : i + 188] for i in range(0, len(stream), 188)]
    assert mpegts.demux(b"".join(packets[:4] + packets[5:])).cc_errors == 1
    assert mpegts.demux(b"".join(packets[:5] + packets[4:])).duplicates == 1
    bad = bytearray(stream)
    bad[0], bad[188 + 20] = 0, bad[188 + 20] ^ 1
    s = mpegts.demux(bytes(bad))
    assert (s.sync_errors, s.crc_errors) == (1, 0) and not s.units
    assert mpegts.demux(b"").packets == mpegts.demux(None).packets == 0
    random.seed(3)
    for _ in range(50):
        mpegts.demux(bytes(random.randrange(256) if random.random() < 0.02 else b for b in stream))
        mpegts.demux(stream[: random.randrange(len(stream))])


def test_ts_tables_over_packets():
    """A program map of 60 streams takes two packets; a second section starts in the packet that ends the first."""
    streams = {0x200 + k: 6 for k in range(60)}
    entries = b"".join(b"\x06" + (0xE000 | p).to_bytes(2, "big") + b"\xf0\x00" for p in streams)
    pmt = mpegts._section(2, 1, (0xE000 | mpegts.ES_PID).to_bytes(2, "big") + b"\xf0\x00" + entries)
    more = mpegts._section(2, 1, (0xE000 | 0x300).to_bytes(2, "big") + b"\xf0\x00\x1b\xe3\x00\xf0\x00")
    packet = lambda pid, start, count, body: bytes([0x47, (0x40 if start else 0) | pid >> 8, pid & 255, 0x10 | count]) + body.ljust(184, b"\xff")
    first, rest = b"\x00" + pmt[:183], pmt[183:]
    stream = packet(0, True, 0, b"\x00" + mpegts.PAT) + packet(mpegts.PMT_PID, True, 0, first) + packet(mpegts.PMT_PID, True, 1, bytes([len(rest)]) + rest + more)
    s = mpegts.demux(stream)
    assert s.streams == streams | {0x300: 0x1B} and s.crc_errors == s.cc_errors == 0
    cut = mpegts.demux(stream[:376] + packet(mpegts.PMT_PID, True, 1, b"\x00" + more))
    assert cut.streams == {0x300: 0x1B} and cut.crc_errors == 1


def test_ts_resynchronises():
    payload = bytes(range(256)) * 40
    stream = mpegts.mux(payload)
    for junk in (b"\x00", b"x" * 100, b"x" * 187, b"x" * 188 + b"yz"):
        s = mpegts.demux(junk + stream)
        assert s.sync_errors >= 1 and s.payload() == payload and not s.cc_errors
    assert mpegts.demux(b"\x47" + stream).payload() == payload[mpegts.RAP_EVERY * mpegts.UNIT :]  # a byte that looks like a start costs a packet, here the first table
    middle = mpegts.demux(stream[: 188 * 5] + b"junk" + stream[188 * 5 :])
    assert middle.sync_errors == 1 and middle.payload() == payload


def test_stamps():
    for t in (0, 1, 2**15, 2**30 + 12345, 2**33 - 1):
        assert mpegts._ticks(mpegts._stamp(2, t)) == t


def documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_op1(spark, tmp_path):
    texts = ["", None, "a", "é" * 96, "x" * 192, "y" * 193, "long " * 40_000, "a", "\U0001f600 \x00"]
    found = {r["doc_id"]: r for r in mpegts.op1_mpeg_transport_streams(spark, documents(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        padded = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = found[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(m := mpegts.mux(padded)), hashlib.sha256(m).hexdigest()) and "faults=0" in r["feature"]
        units = mpegts.demux(m).units
        assert [tuple(u) for u in r["units"]] == [(u.pts, u.random_access, len(u.data)) for u in units] and r["units"][0]["random_access"]
    assert found[0][1:] == found[1][1:] and found[2][1:] == found[7][1:]
    assert mpegts.op1_mpeg_transport_streams(spark, documents(spark, tmp_path / "e", [])).count() == 0


def test_arc_lines():
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody\nfiledesc://x 0.0.0.0 20200101000000 text/plain 3\n"
    for version in (1, 2):
        data = arc.arc_volume("v.arc", version) + arc.arc_record("v.arc", version, "http://a b/", block) + arc.arc_record("v.arc", version, "dns:x", b"", "text/dns", "2001")
        plain, packed = list(arc.read_arc(data)), list(arc.read_arc(b"".join(map(arc._member, (arc.arc_volume("v.arc", version), arc.arc_record("v.arc", version, "http://a b/", block), arc.arc_record("v.arc", version, "dns:x", b"", "text/dns", "2001"))))))
        assert len(plain) == len(packed) - 0 == 2 and plain[0].block == block and plain[0].url == "http://a%20b/"
        (h, b), (h2, _) = (next(arc.read_warc(arc.convert("v", r))) for r in plain)
        assert (h["warc-type"], b, h["warc-date"]) == ("response", block, "2020-01-01T00:00:00Z") and (h2["warc-type"], h2["warc-date"], h2["content-type"]) == ("resource", "2001-01-01T00:00:00Z", "text/dns")
        assert h["warc-payload-digest"] == "sha1:" + b32encode(hashlib.sha1(block.partition(b"\r\n\r\n")[2]).digest()).decode()
    faults = []
    assert [r.url for r in arc.read_arc(data + b"u 0 0 t m 0\n" + b"u 0 0 t 999\nshort", faults)] == ["http://a%20b/", "dns:x"] and len(faults) == 2
    assert list(arc.read_arc(b"")) == list(arc.read_warc(b"junk")) == []


def test_op2(spark, tmp_path):
    pages = [(5, "http://x/5", "same"), (3, "http://x/3", "same"), (9, None, None), (7, "u 7\n", ""), (1, "http://x/1", "WARC/1.1\r\n\r\nfake é"), (2, "http://x/2", "y" * 70_000), (8, "http://x/8", "same"), (8, "http://x/8", "same")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = arc.op2_warc(spark, str(tmp_path)).collect()
    first = {}
    for i, _, h in sorted(pages, key=lambda p: p[0]):
        first.setdefault(h or "", i)
    got = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows if r["page_id"] != 8)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        again = first[h or ""] != i
        want.append((i, len(raw), b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    assert got == sorted((w for w in want if w[0] != 8), key=lambda w: w[0])
    assert [r["refers_to"] for r in rows if r["page_id"] == 8] == [3, 3] and all(r["block_ok"] for r in rows)
    empty = spark.createDataFrame([], "page_id long, url string, html string, volume int")
    assert arc.read_volumes(arc.archive(empty)).count() == 0
    clash = spark.createDataFrame([(1, "u", "z", "a", 5, "b")], "page_id long, url string, html string, `data` string, id int, `a.b` string")
    assert [(r["id"], r["payload_bytes"]) for r in arc.read_volumes(arc.archive(clash)).collect()] == [(1, 1)]
    nulls = spark.createDataFrame([(None, None, "z"), (None, None, "z")], "page_id long, url string, html string")
    assert [(r["id"], r["record_type"]) for r in arc.read_volumes(arc.archive(nulls)).collect()] == [(None, "response")] * 2


def test_many_volumes(spark, monkeypatch):
    monkeypatch.setattr(arc, "VOLUME", 2000)
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.sha2((F.col("id") % 150).cast("string"), 512).alias("html"))
    volumes = arc.write_arc(pages).collect()
    assert {arc.read_arc(v["data"]).__next__().index for v in volumes} == {0}
    found = arc.read_volumes(arc.archive(pages)).collect()
    assert sorted((r["id"], r["refers_to"]) for r in found) == [(i, i - 150 if i >= 150 else None) for i in range(200)]
