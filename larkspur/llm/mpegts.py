"""MPEG transport streams as a media column: multiplex a payload, parse a stream.

A stream is a run of 188-byte packets: a program association table (PID 0), a program map table, and packetised elementary
packets (PES) of one private-data stream. Every access unit has a presentation time; every `rap_every`-th one is a
random-access point, which carries the clock reference and is preceded by both tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, need

PACKET, BODY, SYNC = 188, 184, 0x47
PMT_PID, ES_PID, STREAM_TYPE, STREAM_ID = 0x1000, 0x0100, 0x06, 0xBD  # 0x06: PES with private data
UNIT, TICKS, RAP_EVERY = 1536, 3600, 8  # bytes and 90 kHz ticks of an access unit; units between random-access points
PAD = 192

_CRC = []
for _n in range(256):
    _c = _n << 24
    for _ in range(8):
        _c = (_c << 1) ^ (0x04C11DB7 if _c & 0x80000000 else 0)
    _CRC.append(_c & 0xFFFFFFFF)


def crc_mpeg(data: bytes) -> int:
    """The CRC of table sections; 0 over a section with its own CRC at the end."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    rest = number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    head = bytes([table]) + (0xB000 | len(rest) + 4).to_bytes(2, "big") + rest
    return head + crc_mpeg(head).to_bytes(4, "big")


PAT = _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
PMT = _section(2, 1, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")


def _stamp(mark: int, ticks: int) -> bytes:
    """The 33 bits of a time stamp with their marker bits."""
    return bytes([mark << 4 | ticks >> 29 & 14 | 1, ticks >> 22 & 255, ticks >> 14 & 254 | 1, ticks >> 7 & 255, ticks << 1 & 254 | 1])


def _ticks(b: bytes) -> int:
    return (b[0] & 14) << 29 | b[1] << 22 | (b[2] & 254) << 14 | b[3] << 7 | b[4] >> 1


def mux(payload: bytes, unit: int = UNIT, rap_every: int = RAP_EVERY) -> bytes:
    """payload as a transport stream, of any length; an empty one has both tables and no PES packet."""
    out, counts = [], {0: 0, PMT_PID: 0, ES_PID: 0}

    def tables() -> None:
        for pid, section in ((0, PAT), (PMT_PID, PMT)):
            out.append(bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10 | counts[pid]]) + b"\x00" + section.ljust(BODY - 1, b"\xff"))
            counts[pid] = counts[pid] + 1 & 15

    tables()
    for k, at in enumerate(range(0, len(payload), unit)):
        pts, part = k * TICKS & 0x1FFFFFFFF, payload[at : at + unit]
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(part) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(2, pts) + part
        extra = b""
        if k % rap_every == 0:
            if k:
                tables()
            extra = b"\x50" + (pts << 15 | 0x7E00).to_bytes(6, "big")  # random access, clock reference
        here, first = 0, 0x40
        while here < len(pes):
            room = BODY - (len(extra) + 1 if extra else 0)
            take = min(room, len(pes) - here)
            if take < room or extra:
                stuff = room - take
                if not extra and stuff == 1:
                    field_ = b"\x00"
                else:
                    body = (extra or b"\x00") + b"\xff" * (stuff if extra else stuff - 2)
                    field_ = bytes([len(body)]) + body
                control = 0x30
            else:
                field_, control = b"", 0x10
            out.append(bytes([SYNC, first | ES_PID >> 8, ES_PID & 255, control | counts[ES_PID]]) + field_ + pes[here : here + take])
            counts[ES_PID] = counts[ES_PID] + 1 & 15
            here, first, extra = here + take, 0, b""
    return b"".join(out)


@dataclass
class Unit:
    """One access unit: its stream's PID, its times (None: not given), whether decoding can start there, and its bytes."""

    pid: int
    pts: int | None
    dts: int | None
    random_access: bool
    data: bytes


@dataclass
class Stream:
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, int] = field(default_factory=dict)
    units: list[Unit] = field(default_factory=list)
    packets: int = 0
    sync_errors: int = 0
    crc_errors: int = 0
    cc_errors: int = 0
    duplicates: int = 0

    def payload(self, pid: int | None = None) -> bytes:
        return b"".join(u.data for u in self.units if pid is None or u.pid == pid)


def _in_step(data: bytes, at: int) -> bool:
    """Whether a packet can start at `at`: a sync byte there, and where the next two packets would start."""
    return all(k >= len(data) or data[k] == SYNC for k in range(at, at + 3 * PACKET, PACKET))


def packets(data: bytes) -> Iterator[bytes | None]:
    """The packets of a stream; None for one with a bad sync byte, and once for a run of bytes that belong to no packet.

    Where a sync byte is missing but the ones after it are in step, that packet is lost; else the next place from which three are in step goes on.
    """
    at = 0
    while at + PACKET <= len(data):
        if data[at] == SYNC:
            yield data[at : at + PACKET]
            at += PACKET
            continue
        yield None
        if at + 2 * PACKET <= len(data) and _in_step(data, at + PACKET):
            at += PACKET
            continue
        at = data.find(SYNC, at + 1)
        while at >= 0 and not _in_step(data, at):
            at = data.find(SYNC, at + 1)
        if at < 0:
            return


class _Demux:
    """Puts packets together: sections of tables, and units of the streams that they name."""

    def __init__(self) -> None:
        self.found = Stream()
        self.last: dict[int, tuple[int, bytes]] = {}
        self.units: dict[int, list[bytes]] = {}
        self.random: dict[int, bool] = {}
        self.sections: dict[int, bytes] = {}

    def close(self, pid: int) -> None:
        raw = b"".join(self.units.pop(pid, []))
        if len(raw) < 9 or raw[:3] != b"\x00\x00\x01":
            return
        size, flags, head = int.from_bytes(raw[4:6], "big"), raw[7], 9 + raw[8]
        pts = _ticks(raw[9:14]) if flags & 0x80 and len(raw) >= 14 else None
        dts = _ticks(raw[14:19]) if flags & 0xC0 == 0xC0 and len(raw) >= 19 else pts
        self.found.units.append(Unit(pid, pts, dts, self.random.pop(pid, False), raw[head : 6 + size if size else None]))

    def table(self, pid: int, section: bytes) -> None:
        s = self.found
        if len(section) < 12 or crc_mpeg(section):
            s.crc_errors += 1
        elif not section[5] & 1:
            return  # not in force yet
        elif pid == 0:
            for k in range(8, len(section) - 4, 4):
                if number := int.from_bytes(section[k : k + 2], "big"):
                    s.programs[number] = int.from_bytes(section[k + 2 : k + 4], "big") & 0x1FFF
        else:
            k = 12 + (int.from_bytes(section[10:12], "big") & 0xFFF)
            while k + 5 <= len(section) - 4:
                s.streams[int.from_bytes(section[k + 1 : k + 3], "big") & 0x1FFF] = section[k]
                k += 5 + (int.from_bytes(section[k + 3 : k + 5], "big") & 0xFFF)

    def whole_sections(self, pid: int) -> None:
        """Reads what is whole of a table's bytes so far; stuffing ends them."""
        raw = self.sections[pid]
        while len(raw) >= 3 and raw[0] != 0xFF and len(raw) >= (size := 3 + (int.from_bytes(raw[1:3], "big") & 0xFFF)):
            self.table(pid, raw[:size])
            raw = raw[size:]
        if raw and raw[0] != 0xFF:
            self.sections[pid] = raw
        else:
            del self.sections[pid]

    def tables(self, pid: int, starts: bool, body: bytes) -> None:
        """A section can fill several packets, and a packet can end one and hold others."""
        if not starts:
            if pid in self.sections:
                self.sections[pid] += body
                self.whole_sections(pid)
            return
        if not body:
            return
        before, after = body[1 : 1 + body[0]], body[1 + body[0] :]
        if pid in self.sections:
            self.sections[pid] += before
            self.whole_sections(pid)
            if self.sections.pop(pid, None):
                self.found.crc_errors += 1
        self.sections[pid] = after
        self.whole_sections(pid)

    def add(self, packet: bytes | None) -> None:
        s = self.found
        s.packets += 1
        if packet is None or packet[1] & 0x80:
            s.sync_errors += 1
            return
        pid, starts, control, count = (packet[1] & 31) << 8 | packet[2], bool(packet[1] & 0x40), packet[3] & 0x30, packet[3] & 15
        if pid == 0x1FFF or not control:
            return
        begin, marks = 4, 0
        if control & 0x20:
            marks = packet[5] if packet[4] else 0
            begin = min(5 + packet[4], PACKET)
        if not control & 0x10:
            return
        body, before = packet[begin:], self.last.get(pid)
        if before and not marks & 0x80:
            if before[0] == count and before[1] == body:
                s.duplicates += 1
                return
            if before[0] + 1 & 15 != count:
                s.cc_errors += 1
                self.close(pid)
                self.sections.pop(pid, None)
        self.last[pid] = count, body
        if pid == 0 or pid in s.programs.values():
            self.tables(pid, starts, body)
        elif pid in s.streams:
            if starts:
                self.close(pid)
                self.units[pid], self.random[pid] = [body], bool(marks & 0x40)
            elif pid in self.units:
                self.units[pid].append(body)


def demux(data: bytes | None) -> Stream:
    """What a stream holds. Null: empty.

    Damage never raises: a bad sync byte costs its packet, other bytes those up to the next packets in step; a failed CRC costs its
    section; a continuity break counts, and the unit and section that it falls into end there. A repeated packet counts as a
    duplicate and is dropped.
    """
    d = _Demux()
    for packet in packets(data or b""):
        d.add(packet)
    for pid in list(d.units):
        d.close(pid)
    return d.found


def padded(text: Column | str) -> Column:
    """A text's UTF-8 bytes, followed by spaces up to a positive multiple of PAD. Null: as an empty text."""
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    n = F.octet_length(raw)
    size = F.greatest(F.lit(PAD), ((n + PAD - 1) / PAD).cast("long") * PAD)
    return F.concat(raw, F.encode(F.repeat(F.lit(" "), (size - n).cast("int")), "UTF-8"))


def store(df: DataFrame, id_column: str, payload: str) -> DataFrame:
    """(id, payload binary) to (id, media binary), one stream a row. A null payload gives a null stream. Other columns, media among them, are left out."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                yield [part.column(0), [None if x is None else mux(x) for x in part.column(1).to_pylist()]]

        return work

    kind = df.schema[id_column].dataType.simpleString()
    return map_rows(need(df, id_column, payload), make, f"`{id_column}` {kind}, media binary")


PARSED = "programs map<int,int>, streams map<int,int>, packets long, sync_errors long, crc_errors long, cc_errors long, duplicates long, units array<struct<pid:int,pts:long,dts:long,random_access:boolean,bytes:long>>, payload binary"


def parse(df: DataFrame, id_column: str, media: str = "media") -> DataFrame:
    """(id, media binary) to the tables, faults, access units with times, and reassembled payload of each row's stream.

    Null or empty media: empty tables, no units, an empty payload. Rows come out as often as they came in. Other columns are left out.
    """

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                got = [demux(x) for x in part.column(1).to_pylist()]
                yield [
                    part.column(0),
                    [list(s.programs.items()) for s in got],
                    [list(s.streams.items()) for s in got],
                    *([getattr(s, n) for s in got] for n in ("packets", "sync_errors", "crc_errors", "cc_errors", "duplicates")),
                    [[{"pid": u.pid, "pts": u.pts, "dts": u.dts, "random_access": u.random_access, "bytes": len(u.data)} for u in s.units] for s in got],
                    [s.payload() for s in got],
                ]

        return work

    kind = df.schema[id_column].dataType.simpleString()
    return map_rows(need(df, id_column, media), make, f"`{id_column}` {kind}, {PARSED}")


def op1_mpeg_transport_streams(spark, sf_dir: str) -> DataFrame:
    """A row for each document, null texts as empty ones; units: time stamp, random access and bytes of each access unit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", padded("text").alias("payload"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    media = store(docs.select(F.struct("doc_id", "n").alias("row"), "payload"), "row", "payload")
    media = media.select(F.struct("row.doc_id", "row.n", F.octet_length("media").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256")).alias("row"), "media")
    raps = F.size(F.filter("units", lambda u: u["random_access"]))
    feature = F.format_string(
        "programs=%s;streams=%s;packets=%d;units=%d;random_access=%d;last_pts=%d;faults=%d",
        F.array_join(F.transform(F.map_entries("programs"), lambda e: F.concat_ws(":", e["key"], e["value"])), ","),
        F.array_join(F.transform(F.map_entries("streams"), lambda e: F.concat_ws(":", e["key"], e["value"])), ","),
        "packets", F.size("units"), raps, F.array_max(F.transform("units", lambda u: u["pts"])),
        F.col("sync_errors") + F.col("crc_errors") + F.col("cc_errors"),
    )
    return parse(media, "row").select(
        "row.doc_id", F.col("row.n").cast("long").alias("n_bytes"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"), F.col("row.media_bytes").cast("long").alias("media_bytes"), "row.media_sha256", feature.alias("feature"), F.transform("units", lambda u: F.struct(u["pts"].alias("pts"), u["random_access"].alias("random_access"), u["bytes"].alias("bytes"))).alias("units"),
    )
