"""Legacy ARC archives: write them from pages, convert them to WARC records, read those back.

An archive travels as volumes, rows (volume, data) of gzip members of about VOLUME bytes, so that any reader of tables can
hold one at a time; the volumes of one archive after another are an ordinary .arc.gz or .warc.gz file. Each volume starts with
its own version block or warcinfo record. Both versions of the ARC header line are read:

version 1: URL IP-address Archive-date Content-type Archive-length
version 2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

A record's extent is what its line declares, whatever its bytes hold. The synthesised WARC record has a UUID from archive, place and
URL, the date of the line, the type that the content asks for, and SHA-1 digests of block and payload in base 32.
"""

from __future__ import annotations

import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha1

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, need, written

VOLUME, RECORDS = 1 << 20, 4096  # gzip bytes and records after which a volume ends
LEVEL = 3
DATE, IP = "20200101000000", "0.0.0.0"
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SOURCE, ORIGINAL = "X-Source-Id", "X-Refers-To-Source-Id"  # headers of ours, with the rows' ids


def digest(data: bytes) -> str:
    return b32encode(sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes) -> Iterator[bytes]:
    """The contents of one gzip member after another; of data that is not compressed, all at once."""
    if data[:2] != b"\x1f\x8b":
        if data:
            yield data
        return
    while data[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        yield z.decompress(data) + z.flush()
        data = z.unused_data


@dataclass
class ArcRecord:
    """One document of an ARC volume: its place among them, its line's fields, and the bytes it declares."""

    index: int
    url: str
    ip: str
    date: str
    kind: str
    block: bytes

    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2] if self.block.startswith(b"HTTP/") else self.block

    def header(self, name: str) -> str | None:
        """A header of the HTTP response in the block."""
        if not self.block.startswith(b"HTTP/"):
            return None
        m = re.search(rb"\r\n" + name.encode() + rb":[ \t]*([^\r\n]*)", self.block.partition(b"\r\n\r\n")[0], re.I)
        return m[1].decode("latin-1").strip() if m else None


def arc_volume(name: str, version: int) -> bytes:
    """The version block that starts a volume."""
    body = f"{version} 0 larkspur\n{FIELDS[version]}\n".encode()
    line = f"filedesc://{name} {IP} {DATE} text/plain " + (f"200 - - 0 {name} " if version == 2 else "") + f"{len(body)}\n"
    return line.encode() + body + b"\n"


def arc_record(name: str, version: int, url: str, block: bytes, kind: str = "text/html", date: str = DATE, ip: str = IP, at: int = 0) -> bytes:
    """A header line, the block and an empty line. White space in a URL is escaped, since it would split the line."""
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "-"
    more = f"200 {digest(block)} - {at} {name} " if version == 2 else ""
    return f"{url} {ip} {date} {kind} {more}{len(block)}\n".encode() + block + b"\n"


def read_arc(data: bytes, faults: list[str] | None = None) -> Iterator[ArcRecord]:
    """The documents of a volume, by declared length; version blocks set the line's form.

    A line with another number of fields is passed over with its block, one with a bad length ends its member; `faults` gets each such line.
    """
    index, fields = 0, len(FIELDS[1].split())
    for part in members(data):
        at = 0
        while at < len(part):
            if part[at : at + 1] in b"\r\n":
                at += 1
                continue
            end = part.find(b"\n", at)
            line = part[at : end if end >= 0 else len(part)].decode("utf-8", "replace").rstrip("\r").split(" ")
            if end < 0 or len(line) < 5 or not line[-1].isdigit() or int(line[-1]) > len(part) - end - 1:
                if faults is not None:
                    faults.append(" ".join(line))
                break
            block = part[end + 1 : end + 1 + int(line[-1])]
            at = end + 1 + len(block)
            if line[0].startswith("filedesc:"):
                fields = len(FIELDS[2 if block[:1] == b"2" else 1].split())
            elif len(line) == fields:
                yield ArcRecord(index, line[0], line[1], line[2], line[3], block)
                index += 1
            elif faults is not None:
                faults.append(" ".join(line))


def warc_date(date: str) -> str:
    """An ARC date of 14 digits, or fewer of 4 at least, as WARC writes it; anything else is the epoch."""
    if not re.fullmatch(r"\d{4,14}", date):
        date = "19700101"
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(volume: str, r: ArcRecord) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{volume}#{r.index} {r.date} {r.url}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def convert(volume: str, r: ArcRecord, original: dict | None = None) -> bytes:
    """An ARC document as a WARC record: a response for HTTP blocks, a resource for others, a revisit of `original` where given."""
    payload, http = r.payload(), r.block.startswith(b"HTTP/")
    headers = [
        ("WARC-Type", "revisit" if original else "response" if http else "resource"), ("WARC-Record-ID", record_id(volume, r)), ("WARC-Date", warc_date(r.date)), ("WARC-Target-URI", r.url),
        ("WARC-IP-Address", r.ip), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http;msgtype=response" if http else r.kind),
    ]
    block = r.block
    if original:
        block = r.block[: len(r.block) - len(payload)]
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", original["record"]), ("WARC-Refers-To-Target-URI", original["url"]), ("WARC-Refers-To-Date", original["date"]), (ORIGINAL, str(original["id"]))]
    if source := r.header(SOURCE):
        headers.append((SOURCE, source))
    return warc_record([*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("X-Payload-Length", str(len(payload)))], block)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record, by declared length. What is not a record ends its member."""
    for part in members(data):
        at = 0
        while part.startswith(b"WARC/", at):
            end = part.find(b"\r\n\r\n", at)
            if end < 0:
                break
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in part[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
            n = headers.get("content-length", "")
            if not n.isdigit():
                break
            yield headers, part[end + 4 : end + 4 + int(n)]
            at = end + 4 + int(n) + 4


class _Volumes:
    """Collects gzip members into volumes of a name for each task and count."""

    def __init__(self, kind: str, start: Callable[[str, int], bytes]):
        from pyspark import TaskContext

        self.part = TaskContext.get().partitionId()
        self.kind, self.start, self.count = kind, start, 0
        self.open_()

    def open_(self) -> None:
        self.version = self.count % 2 + 1
        self.name = f"{self.part:06d}-{self.count:06d}.{self.kind}.gz"
        self.data, self.size, self.records = [_member(self.start(self.name, self.version))], 0, 0
        self.count += 1

    def add(self, record: bytes) -> Iterator[list]:
        member = _member(record)
        self.data.append(member)
        self.size += len(member)
        self.records += 1
        if self.size >= VOLUME or self.records >= RECORDS:
            yield from self.finish()
            self.open_()

    def finish(self) -> Iterator[list]:
        if self.records:
            yield [[self.name], [b"".join(self.data)]]
            self.records = 0


def write_arc(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) to ARC volumes, of both versions in turn. Each row is a document, an HTTP response with the html in UTF-8 (null: empty), repeated rows too; other columns are left out."""

    class Write(_Volumes):
        def __init__(self) -> None:
            super().__init__("arc", arc_volume)

        def __call__(self, batch) -> Iterator[list]:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n" + ("" if page is None else f"{SOURCE}: {page}\r\n")
                yield from self.add(arc_record(self.name, self.version, url or "-", head.encode() + b"\r\n" + body, at=self.size))

    return map_rows(need(pages, "page_id", "url", "html"), Write, "volume string, data binary")


def index_arc(volumes: DataFrame) -> DataFrame:
    """What converting has to know of each document before it starts: (volume, place, id, record, url, date, digest)."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = [(name, r.index, int(i) if (i := r.header(SOURCE)) else None, record_id(name, r), r.url, warc_date(r.date), digest(r.payload())) for r in read_arc(data)]
                if found:
                    yield [list(c) for c in zip(*found, strict=True)]

        return work

    return map_rows(volumes, make, "volume string, place int, id long, record string, url string, date string, digest string")


ORIGINAL_OF = "struct<place:int,original:struct<id:long,record:string,url:string,date:string>>"


def revisits(index: DataFrame) -> DataFrame:
    """(volume, revisits) of the documents whose payload another has with a smaller id. Documents without an id take no part; of equal ids the smallest record id counts."""
    known = index.where("id is not null")
    first = known.groupBy("digest").agg(F.min(F.struct("id", "record", "url", "date")).alias("original"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = known.select("volume", "place", "record", "digest").join(first, "digest").where("record <> original.record")
    return again.groupBy("volume").agg(F.collect_list(F.struct("place", "original")).alias("revisits"))  # RECORDS at most


def convert_volumes(volumes: DataFrame, again: DataFrame) -> DataFrame:
    """ARC volumes and revisits() to WARC volumes, one for each; faults: how many of its lines were not documents."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            for name, data, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                original = {x["place"]: x["original"] for x in found or ()}
                out = f"{name.removesuffix('.arc.gz')}.warc.gz"
                info = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, out)}>"), ("WARC-Date", warc_date(DATE)), ("WARC-Filename", out), ("Content-Type", "application/warc-fields")], f"format: WARC File Format 1.1\r\nconverted-from: {name}\r\n".encode())
                faults: list[str] = []
                records = [_member(convert(name, r, original.get(r.index))) for r in read_arc(data, faults)]
                yield [[out], [b"".join([_member(info), *records])], [len(faults)]]

        return work

    return map_rows(volumes.join(again, "volume", "left").select("volume", "data", "revisits"), make, "volume string, data binary, faults long")


RECORD = "id long, record string, record_type string, url string, date string, payload_bytes long, payload_digest string, refers_to long, block_ok boolean"


def read_volumes(volumes: DataFrame) -> DataFrame:
    """WARC volumes to one row for each record but warcinfo. block_ok: the block has the digest that the record declares."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            for data in batch.column(0).to_pylist():
                rows = []
                for h, block in read_warc(data):
                    if h.get("warc-type") != "warcinfo":
                        whole = h["warc-type"] != "revisit"
                        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                        n = len(payload) if whole else int(h["x-payload-length"])
                        sha = digest(payload) if whole else h["warc-payload-digest"].removeprefix("sha1:")
                        rows.append((int(h[k]) if (k := SOURCE.lower()) in h else None, h["warc-record-id"], h["warc-type"], h["warc-target-uri"], h["warc-date"], n, sha, int(h[k]) if (k := ORIGINAL.lower()) in h else None, h["warc-block-digest"] == f"sha1:{digest(block)}"))
                if rows:
                    yield [list(c) for c in zip(*rows, strict=True)]

        return work

    return map_rows(need(volumes, "data"), make, RECORD)


def archive(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) through ARC volumes and their conversion to WARC volumes, written to the shared folder.

    Of repeated rows, and of pages with equal ids, each has a record. Rows with a null id have responses of their own. An empty table gives no volumes.
    """
    arcs = written(write_arc(pages), "arc")
    again = written(revisits(index_arc(arcs)), "revisits")
    return written(convert_volumes(arcs, again), "warc")


def op2_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_volumes(archive(pages)).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date", "record", "block_ok")
