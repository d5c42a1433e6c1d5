"""Byte-level BPE: encoding folds ranked merges over the bytes of distinct words, decoding concatenates the pieces of ids.

A text is cut by a pattern into words; a word's bytes are merged, always the adjacent pair whose bytes together have the lowest
rank and the leftmost of equals, until no pair has one. A word is folded once and found again: in a batch, and in a bounded cache
from batch to batch. folded() is the same fold in Spark's higher-order functions over a table of distinct words.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, need

VOCABULARY = "byte_bpe_50k"
CACHE = 600_000
#: The characters of Unicode's White_Space property, as a part of a character class.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_OPEN = re.compile(" (?:\\s|\\Z)")  # a space before which a text cannot be cut


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def ranks_and_pattern(name: str = VOCABULARY) -> tuple[dict[bytes, int], str]:
    """The ranks, and the pattern with White_Space spelled out, since libraries' \\s differ."""
    import public_tokenizers

    pattern = public_tokenizers.PATTERN.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]")
    return load_ranks(public_tokenizers.path(f"{name}.tiktoken")), pattern


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word. A word that is a token is that token."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 64:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get = ranks.get
    near = [get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while True:
        low, at = None, -1
        for i, r in enumerate(near):
            if r is not None and (low is None or r < low):
                low, at = r, i
        if low is None:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del near[at]
        if at < len(near):
            near[at] = get(parts[at] + parts[at + 1])
        if at:
            near[at - 1] = get(parts[at - 1] + parts[at])


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n steps: a heap of pairs, where pairs that have changed meanwhile are passed over."""
    n = len(word)
    end, after, before, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heappush(heap, (r, i, end[after[i]]))
        if (k := before[i]) >= 0 and (r := ranks.get(word[k:stop])) is not None:
            heappush(heap, (r, k, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class _Bounded(dict):
    """What make() gives for a key; kept, up to CACHE of them."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.clear()
        self[key] = found = self.make(key)
        return found


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One for each Python worker, which keeps what it has folded from task to task."""
    return Encoder(name)


class Encoder:
    """Texts to ids, as little-endian 32-bit integers."""

    def __init__(self, name: str = VOCABULARY):
        import regex

        self.ranks, pattern = ranks_and_pattern(name)
        self.split = regex.compile(pattern).findall
        self.words = _Bounded(lambda w: np.array(fold(w.encode("utf-8", "replace"), self.ranks), "<i4").tobytes())
        self.after_space = _Bounded(lambda part: self.whole(f" {part}"))

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def __call__(self, text: str) -> bytes:
        """Before a space that something else than white space follows, no match of the pattern goes on; so the text can be cut there."""
        if _OPEN.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.after_space.__getitem__, rest))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = VOCABULARY) -> DataFrame:
    """(key, text) to (key, ids array<int>). Null and empty texts have no ids; special tokens' strings are ordinary text. Every row gives one row."""

    def make() -> Callable:
        code = encoder(name)

        def work(batch) -> Iterator[list]:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [code(t) if t else b"" for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
                yield [part.column(0), pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<i4"))]

        return work

    return map_rows(need(docs, key, text), make, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column, null ones empty, without an object for each value but its integer."""
    if column.null_count:
        yield from (x or [] for x in column.to_pylist())
        return
    values, ends = column.values.to_numpy(), column.offsets.to_pylist()
    for a, b in zip(ends, ends[1:], strict=False):
        yield values[a:b].tolist()


def decode(encoded: DataFrame, key: str = "doc_id", name: str = VOCABULARY) -> DataFrame:
    """(key, ids) to (key, ids, bytes binary): the pieces of the ids, one after another. Null ids: none. An id that is no rank raises."""

    def make() -> Callable:
        pieces = {r: b for b, r in ranks_and_pattern(name)[0].items()}

        def work(batch) -> Iterator[list]:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield [part.column(0), part.column(1), [b"".join(map(pieces.__getitem__, ids)) for ids in _lists(part.column(1))]]

        return work

    return map_rows(need(encoded, key, "ids"), make, f"`{key}` {encoded.schema[key].dataType.simpleString()}, ids array<int>, bytes binary")


BUCKETS = 1 << 14


def folded(words: DataFrame, word: str = "word", name: str = VOCABULARY) -> DataFrame:
    """Distinct words with their ids, by Spark's higher-order functions alone: an aggregate over the bytes' places merges one pair a step.

    The rank map is a literal: hexadecimal bytes to ranks in BUCKETS small maps, chosen by hash, since a map is searched from end to end.
    """
    import json
    import zlib

    ranks = ranks_and_pattern(name)[0]
    table: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for b, r in ranks.items():
        h = b.hex().upper()
        table[zlib.crc32(h.encode()) % BUCKETS][h] = r
    literal = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")

    def rank(piece: Column) -> Column:
        return F.try_element_at(F.get(literal, (F.crc32(piece.cast("binary")) % BUCKETS).cast("int")), piece)

    def step(parts: Column, _: Column) -> Column:
        near = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda a, i: F.struct(F.coalesce(rank(F.concat(a, F.get(parts, i + 1))), F.lit(1 << 30)).alias("rank"), i.alias("at")))
        best = F.array_min(near)
        at = best["at"]
        merged = F.concat(F.slice(parts, 1, at), F.array(F.concat(F.get(parts, at), F.get(parts, at + 1))), F.slice(parts, at + 3, F.size(parts)))
        return F.when(best["rank"] < (1 << 30), merged).otherwise(parts)

    whole = F.hex(F.encode(word, "UTF-8"))
    size = (F.length(whole) / 2).cast("int")
    bytes_ = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(whole, i * 2 + 1, F.lit(2)))
    parts = F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), bytes_, step)
    ids = F.when(rank(whole).isNotNull(), F.array(rank(whole))).otherwise(F.transform(parts, rank))
    return words.where(F.length(word) > 0).select(word, ids.alias("ids"))


def op8_byte_level_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    decoded = decode(encode(docs))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
