"""Personal data by patterns, and information-theoretic sanitisation of the terms that give it away.

Patterns find the protected entities. Over the whole corpus, the text around each entity tells how much a term reveals: the
pointwise mutual information of term and entity, log2(N n(e, t) / (n(e) n(t))), against the information of the entity itself,
log2(N / n(e)). The share is 1 for a term that never occurs without the entity. With n(.) counts of documents, terms within
WINDOW words of an entity, however few documents that are, are generalised where the share is at least GENERALISE and removed
where it is at least REMOVE: every occurrence outside the patterns' matches, in all documents, near the entity or not, by the
largest share that the term has with any entity. What the patterns found stays found.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, need, written

KINDS = ("email", "ip", "card", "phone")
WINDOW, GENERALISE, REMOVE = 4, 0.85, 0.97
COUNTED = 150_000  # distinct terms that one task counts before it passes them on
FILTER_WORDS = 1 << 17  # 64-bit words of the filter that spares terms outside it the join; full, it spares fewer

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d <<= k & 1
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost and non-overlapping: from each @ back over its local part, which the match before can cut, and on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches by start, then kind as in KINDS; places count code points. Null: none."""
    if not text:
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _entity(kind: str, value: str) -> str:
    """What identifies an entity however it is written."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else _NOT_DIGIT.sub('', value)}"


def _around(text: str, start: int, end: int, taken: list[tuple[str, int, int]]) -> list[str]:
    """The terms among the WINDOW words on either side, without those within an entity."""
    left, right = start, end
    for _ in range(WINDOW):
        left = max(text.rfind(" ", 0, max(left - 1, 0)) + 1 if left > 0 else 0, 0)
    for _ in range(WINDOW + 1):
        k = text.find(" ", right + 1)
        right = len(text) if k < 0 else k
        if k < 0:
            break
    out = []
    for m in (*_TERM.finditer(text, left, start), *_TERM.finditer(text, end, right)):
        if not any(s < m.end() and m.start() < e for _, s, e in taken):
            out.append(m[0].lower())
    return out


SPAN = "struct<kind:string,start:long,end:long>"
FOUND = f"spans array<{SPAN}>, near array<struct<entity:string,term:string>>"


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, text) to (key, spans, near): the patterns' matches, and the terms around each entity. Every row gives one row."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            spans, near = [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                near.append([{"entity": _entity(k, text[s:e]), "term": t} for k, s, e in found for t in _around(text, s, e, found)])
            yield [batch.column(0), spans, near]

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(need(docs, key, "text"), make, f"`{key}` {kind}, {FOUND}")


def document_counts(docs: DataFrame) -> DataFrame:
    """(text) to (term, n): in how many documents each term occurs. Tasks add up before the shuffle, COUNTED terms at a time."""

    class Count:
        def __init__(self) -> None:
            self.seen: Counter = Counter()
            self.parts: dict[str, tuple[str, ...]] = {}

        def terms(self, word: str) -> tuple[str, ...]:
            found = self.parts.get(word)
            if found is None:
                if len(self.parts) >= COUNTED:
                    self.parts.clear()
                self.parts[word] = found = tuple(_TERM.findall(word))
            return found

        def __call__(self, batch) -> Iterator[list]:
            for text in batch.column(0).to_pylist():
                self.seen.update({t for w in set((text or "").lower().split()) for t in self.terms(w)})
                if len(self.seen) >= COUNTED:
                    yield from self.finish()

        def finish(self) -> Iterator[list]:
            if self.seen:
                yield [list(self.seen), list(self.seen.values())]
                self.seen = Counter()

    return map_rows(need(docs, "text"), Count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosure(near: DataFrame, counts: DataFrame, documents: int) -> DataFrame:
    """Distinct (entity, term, doc) with the documents' number of each term to (entity, term, share) of the pairs to sanitise."""
    together = near.groupBy("entity", "term").agg(F.count("*").alias("both"))
    entities = near.select("entity", "doc").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    met = together.join(entities, "entity").join(counts, "term")
    n = F.lit(float(max(documents, 1)))
    information = F.log2(n / F.col("n_entity"))
    mutual = F.log2(n * F.col("both") / (F.col("n_entity") * F.greatest("n", "both")))
    return met.where(information > 0).select("entity", "term", (mutual / information).alias("share")).where(F.col("share") >= GENERALISE)


def _marks(term: str) -> Iterator[int]:
    """The two bits of a term in the filter, as _filter() sets them."""
    raw = term.encode()
    return (crc32(raw + salt) % (64 * FILTER_WORDS) for salt in (b"", b"+"))


def _filter(terms: DataFrame) -> array:
    """Terms (term) to a filter of FILTER_WORDS words: of fixed size, whatever there is of terms."""
    bit = F.explode(F.array(*(F.crc32(F.encode(F.concat("term", F.lit(salt)), "UTF-8")) % (64 * FILTER_WORDS) for salt in ("", "+"))))
    words = terms.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).cast("int").alias("b")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("m"))
    out = array("Q", bytes(8 * FILTER_WORDS))
    for r in words.collect():
        out[r["b"]] = r["m"] & (1 << 64) - 1
    return out


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """docs (doc_id, text) to (doc_id, h, term, start, end): where terms (term) stand outside the patterns' matches; h is the text's XXH64.

    Terms that are not asked for can be among them, as few as the filter lets through.
    """
    words = _filter(terms)

    class Find:
        def __init__(self) -> None:
            self.parts: dict[str, tuple[str, ...]] = {}

        def wanted(self, word: str) -> tuple[str, ...]:
            found = self.parts.get(word)
            if found is None:
                if len(self.parts) >= COUNTED:
                    self.parts.clear()
                self.parts[word] = found = tuple(t for t in _TERM.findall(word) if all(words[b >> 6] >> (b & 63) & 1 for b in _marks(t)))
            return found

        def __call__(self, batch) -> Iterator[list]:
            out: tuple = [], [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                if not text:
                    continue
                # the two letters whose small form depends on what is around them
                split = text.lower().split() if "\u0130" not in text and "\u03a3" not in text else [m[0].lower() for m in _TERM.finditer(text)]
                hit = {t for w in set(split) for t in self.wanted(w)} | {w for w in split if "\u0307" in w}
                if not hit:
                    continue
                taken, at = sorted((s, e) for _, s, e in base_spans(text)), 0
                for m in _TERM.finditer(text):
                    if (term := m[0].lower()) in hit:
                        while at < len(taken) and taken[at][1] <= m.start():
                            at += 1
                        if not any(s < m.end() and m.start() < e for s, e in taken[at:]):
                            for column, value in zip(out, (k, term, m.start(), m.end()), strict=True):
                                column.append(value)
            rows = pa.array(out[0], pa.int64())
            yield [batch.column(0).take(rows), batch.column(1).take(rows), *out[1:]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", F.xxhash64("text").alias("h"), "text"), Find, f"doc_id {kind}, h long, term string, start long, end long")


def sanitise(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to (row, base, spans): row numbers the rows, base holds the patterns' spans, spans all of them by start.

    A span's kind is that of its pattern, `generalise` or `remove`; start and end count code points. Null and empty texts have
    none. Each row gives one row, repeated ones and those with a null id too; ids only count as documents.
    """
    rows = written(scan(docs.select(F.struct("doc_id", F.xxhash64("text").alias("text")).alias("key"), "text"), "key").select("key", "spans", "near").withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    seen = written(rows.select(F.col("row").alias("doc"), F.explode("near").alias("x")).select("x.entity", "x.term", "doc").distinct(), "pii-near")
    told = written(disclosure(seen, document_counts(docs), rows.count()).groupBy("term").agg(F.max("share").alias("share")), "pii-told")
    kind = F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise").alias("kind")
    extra = occurrences(docs, told).join(told, "term").groupBy("doc_id", "h").agg(F.collect_set(F.struct(kind, "start", "end")).alias("extra"))
    order = {k: i for i, k in enumerate((*KINDS, "generalise", "remove"))}
    rank = F.create_map(*(F.lit(x) for p in order.items() for x in p))
    every = F.concat("spans", F.coalesce("extra", F.array().cast(f"array<{SPAN}>")))
    every = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    same = F.col("key.doc_id").eqNullSafe(F.col("doc_id")) & F.col("key.text").eqNullSafe(F.col("h"))
    return rows.join(extra, same, "left").select("key.doc_id", F.col("key.text").alias("text_hash"), F.col("spans").alias("base"), every.alias("spans"))


#: What stands for a span in a sanitised text.
INSTEAD = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": ""}


def generalised(term: str) -> str:
    """The kind of word that a term is, as far as its letters tell: an abbreviation, a name, or a word."""
    return "[ABBREVIATION]" if len(term) > 1 and term.isupper() else "[NAME]" if term[:1].isupper() else "[WORD]"


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced; where spans overlap, the first by start covers them all."""
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], generalised(text[start:end]) if kind == "generalise" else INSTEAD[kind]]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and any other columns) with the spans of sanitise() replaced in text.

    Every row stays, repeated ones and those with a null doc_id too; null and empty texts stay as they are. Other columns keep
    their values, whatever their names. An empty table gives an empty one.
    """
    found = sanitise(docs.select("doc_id", "text")).where("size(spans) > 0")
    found = found.select(F.col("doc_id").alias("_larkspur_id"), F.col("text_hash").alias("_larkspur_hash2"), F.col("spans").alias("_larkspur_spans")).dropDuplicates(["_larkspur_id", "_larkspur_hash2"])
    same = F.col("doc_id").eqNullSafe(F.col("_larkspur_id")) & (F.col("_larkspur_hash") == F.col("_larkspur_hash2"))
    joined = docs.withColumn("_larkspur_hash", F.xxhash64("text")).join(found, same, "left").select(*(F.col(f"`{c}`") for c in docs.columns), "_larkspur_spans")
    text = docs.columns.index("text")

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            spans = batch.column(len(docs_columns)).to_pylist()
            columns = batch.columns[:-1]
            columns[text] = [redacted(t, [(x["kind"], x["start"], x["end"]) for x in s or ()]) for t, s in zip(batch.column(text).to_pylist(), spans, strict=True)]
            yield columns

        return work

    docs_columns = list(docs.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(joined, make, kinds)


def _joined(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """One row for each document, repeated ones and null texts too: the numbers and the digest of the patterns' spans, and all spans."""
    found = sanitise(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
