"""Best-fit packing of documents' tokens into sequences of one capacity, by a configuration linear program.

A configuration is a multiset of lengths that fits one sequence. Only the histogram of lengths enters the program: least
number of sequences so that the chosen configurations cover every length. It is solved by multiplicative weights: the weight of
a length, by which its tokens are priced, falls with the share of its count that is covered, a knapsack dynamic program finds the
best configurations under these prices, and each is taken as often as raises the share of one of its lengths by a fixed step.
Prices over the value of the best configuration are a solution of the dual program, so that each round also bounds from below how
many sequences there have to be. The fractional solution's whole parts are taken, and what is left, as much as a constant number of
sequences holds whatever the input, is filled by best fit. Pieces then find their place by their rank among those of their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, need, written

CAPACITY = 2048
MANY = 12  # configurations from one dynamic program at most
SHARE, ETA = 0.1, 1.0  # of a length's count that one round covers at most; how fast its weight falls with that
PART = 100_000  # pieces of one length, on average, that are ranked in one part; there are 64 parts at least
END_ID = 0
TOKENIZER = "byte_bpe_50k"


def tokenizer(name: str = TOKENIZER) -> Callable[[str], np.ndarray]:
    """Text to ids, as the tokenizers library gives them for {name}.json without added special tokens.

    The merges run in tiktoken over the rank file of the same vocabulary, several times faster; a special token's own string
    in a text gives its id there too.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    code = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: code.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """docs (doc_id, text) to (doc_id, piece, start, length, ids_crc32): a text's ids and the end id, cut only where longer than capacity.

    The first piece of a cut document takes the remainder, the others are full. A null text counts as empty: the end id alone.
    """

    def make() -> Callable:
        encode = tokenizer(name)

        def work(batch) -> Iterator[list]:
            rows: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text), END_ID).astype("<u4") if text else np.array([END_ID], "<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : start + (capacity if k else first)]
                    for column, value in zip(rows, (doc, k, start, len(part), crc32(part.tobytes())), strict=True):
                        column.append(value)
            yield rows

        return work

    return map_rows(need(docs, "doc_id", "text"), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_configurations(lengths: np.ndarray, values: np.ndarray, capacity: int, many: int = MANY, slack: float = 0.01) -> list[dict[int, int]]:
    """Up to `many` multisets of lengths that fit capacity, of the largest total value and within `slack` of it.

    One dynamic program over the room left serves them all: each starts with another length and goes on as the program says.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    up_to = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(int(lengths[0]), capacity + 1):
        n = up_to[room]
        totals = best[room - lengths[:n]] + values[:n]
        k = totals.argmax()
        if totals[k] > best[room - 1]:
            best[room], last[room] = totals[k], k
        else:
            best[room] = best[room - 1]
    first = values + best[capacity - lengths]
    out: dict[tuple, dict[int, int]] = {}
    for k in np.argsort(-first, kind="stable")[: 4 * many].tolist():
        if first[k] < (1 - slack) * first.max() or len(out) == many:
            break
        took, room = Counter({int(lengths[k]): 1}), capacity - int(lengths[k])
        while room > 0:
            if last[room] < 0:
                room -= 1
            else:
                took[int(lengths[last[room]])] += 1
                room -= int(lengths[last[room]])
        out.setdefault(tuple(sorted(took.items())), dict(took))
    return list(out.values())


def solve(histogram: dict[int, int], capacity: int = CAPACITY, share: float = SHARE, eta: float = ETA, bounds: list[float] | None = None) -> list[tuple[dict[int, int], float]]:
    """Configurations with their fractional number, that cover the histogram exactly; bounds gets each round's lower bound.

    Weights fall exponentially with the share of a length's count that is covered. A configuration is taken as often as
    raises the share of one of its lengths by `share`, and of none beyond 1; so len(histogram) / share are taken at most,
    however many pieces there are.
    """
    lengths = np.array(sorted(histogram), int)
    left = {n: float(histogram[n]) for n in lengths.tolist()}
    found: Counter = Counter()
    while len(lengths):
        covered = np.array([1 - left[n] / histogram[n] for n in lengths.tolist()])
        values = np.exp(-(covered - covered.min()) / eta) * lengths / capacity
        best = best_configurations(lengths, values, capacity)
        if bounds is not None:
            price = dict(zip(lengths.tolist(), values.tolist(), strict=True))
            bounds.append(sum(histogram[n] * y for n, y in price.items()) / sum(c * price[n] for n, c in best[0].items()))
        for took in best:
            often = min(min(share * histogram[n], left[n]) / c for n, c in took.items())
            if often <= 0:
                continue
            for n, c in took.items():
                left[n] = left[n] - often * c if left[n] - often * c > 1e-9 * histogram[n] else 0.0
            found[tuple(sorted(took.items()))] += often
        lengths = lengths[[left[n] > 0 for n in lengths.tolist()]]
    return [(dict(c), x) for c, x in found.items()]


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> float:
    """What no packing of these lengths, fractional ones included, can be below, from the prices of all rounds."""
    short, bounds = {n: c for n, c in histogram.items() if n < capacity}, [0.0]
    solve(short, capacity, bounds=bounds)
    return max(bounds) + histogram.get(capacity, 0)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Lengths into sequences, longest first, each into the one with the least room that it fits."""
    rooms: list[tuple[int, int]] = []
    out: list[list[int]] = []
    for n in sorted(lengths, reverse=True):
        k = bisect_left(rooms, (n, -1))
        if k < len(rooms):
            room, at = rooms.pop(k)
        else:
            room, at = capacity, len(out)
            out.append([])
        out[at].append(n)
        if room > n:
            insort(rooms, (room - n, at))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole numbers that hold exactly the histogram's pieces. Full lengths take a sequence each."""
    short = {n: c for n, c in histogram.items() if n < capacity}
    whole = [(c, int(x + 1e-6)) for c, x in solve(short, capacity)]
    left = Counter(short)
    for c, x in whole:
        for n, k in c.items():
            left[n] -= k * x
    rest = Counter(tuple(sorted(Counter(b).items())) for b in best_fit(list(left.elements()), capacity))
    full = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    return full + [(c, x) for c, x in whole if x] + [(dict(c), x) for c, x in rest.items()]


def _runs(configurations: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, copies in a sequence, place of the first copy): where the pieces of each length go, by rank."""
    rank: Counter = Counter()
    out, sequence = [], 0
    for took, times in configurations:
        place = 0
        for n, copies in sorted(took.items(), reverse=True):
            out.append((n, rank[n], copies * times, sequence, copies, place))
            rank[n] += copies * times
            place += n * copies
        sequence += times
    return out


def _ranked(found: DataFrame, salts: int) -> DataFrame:
    """Pieces with their rank, from 0, among those of their length. A length that many pieces share is ranked in `salts` parts, each after the parts before it."""
    from pyspark.sql import Window as W

    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(W.partitionBy("length").orderBy("_salt")) - F.col("_n"))
    within = F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return salted.withColumn("_within", within).join(before.drop("_n"), ["length", "_salt"]).withColumn("rank", F.col("_before") + F.col("_within")).drop("_salt", "_within", "_before")


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) to the same with sequence_id and offset: each sequence is gapless from 0.

    Every row is placed once, repeated ones and those with a null id too. A length over capacity or below 1 raises.
    Only the histogram, capacity + 1 counts at most, reaches the driver, and only the runs are broadcast: at most four for
    each of the configurations taken, whose number the capacity bounds.
    """
    spark = found.sparkSession
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").limit(capacity + 2).collect()}
    if any(n < 1 or n > capacity for n in histogram):
        raise ValueError(f"lengths have to be from 1 to {capacity}")
    by_length: dict[int, list] = {}
    for n, *run in _runs(plan(histogram, capacity)):
        by_length.setdefault(n, []).append(run)
    send = spark.sparkContext.broadcast({n: np.array(runs, np.int64) for n, runs in by_length.items()})

    def make() -> Callable:
        runs = send.value

        def work(batch) -> Iterator[list]:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at, table = np.flatnonzero(length == n), runs[n]
                k = np.searchsorted(table[:, 0], rank[at], side="right") - 1
                nth = rank[at] - table[k, 0]
                sequence[at] = table[k, 2] + nth // table[k, 3]
                offset[at] = table[k, 4] + nth % table[k, 3] * n
            yield [*batch.columns[:-1], sequence, offset]

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    salts = max(64, max(histogram.values(), default=0) // PART)
    return map_rows(_ranked(found, salts).select(*found.columns, "rank"), make, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """docs (doc_id, text) to pieces of tokens with their places. Null and empty texts are the end id alone.

    Rows are packed as often as they occur, those with a null id too. Other columns do not matter; an empty table gives an empty one.
    """
    return pack(written(pieces(docs, capacity, name), "pieces"), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
