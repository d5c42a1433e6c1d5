"""Approximate nearest neighbours by inner product, with cross-polytope hashing.

Vectors are scaled and given one more coordinate so that they lie on the unit sphere and nearness there is the inner product:
within a class of like norms, x becomes (x, sqrt(M^2 - |x|^2)) / M with M the largest norm of the class. Each of TABLES tables has
its own pseudo-rotation, three times random signs and a fast Hadamard transform, and keeps a vector under the nearest
signed axis. A query looks under its PROBES nearest axes in each table and in each class; what it finds is ranked by the
exact inner product of the original vectors. Copies of a vector are searched once.

Keys hold one axis whatever the number of vectors: with keys of two, the same tables and probes find few of the neighbours. So the
part of all vectors that a query is compared with stays as it is, and buckets grow with the vectors; CHUNK splits them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, map_rows, need, written

TABLES, PROBES, TURNS, SEED = 20, 8, 3, 20
TOP = 20
BUCKET = 4096  # vectors that a bucket should hold on average, if nearest() is asked for keys of more axes
CHUNK = 2048  # rows of a bucket that one task compares at a time


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x, h = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n), 2 * h
    return x / np.sqrt(n)


def rotations(size: int, tables: int, hashes: int, seed: int = SEED) -> np.ndarray:
    """Random signs: table, hash of the table, turn, coordinate."""
    return np.random.default_rng([seed, size]).choice([-1.0, 1.0], (tables, hashes, TURNS, size))


def axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Each row's closeness to the 2 n signed axes after one pseudo-rotation: +axis 0, -axis 0, +axis 1 and so on."""
    for s in signs:
        x = hadamard(x * s)
    return np.stack([x, -x], axis=2).reshape(len(x), -1)


def lifted(x: np.ndarray, size: int, norm: float | None) -> np.ndarray:
    """Rows on the unit sphere, padded with zeros; norm None: queries, scaled to length 1."""
    out = np.zeros((len(x), size))
    own = np.linalg.norm(x, axis=1)
    if norm is None:
        out[:, : x.shape[1]] = x / own[:, None]
    else:
        out[:, : x.shape[1]] = x / norm
        out[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (own / norm) ** 2))
    return out


def _size(dimensions: int) -> int:
    return 1 << max(dimensions, 1).bit_length()  # the next power of two above, for the coordinate that is added


def hash_rows(x: np.ndarray, tables: int, hashes: int, probes: int, norm: float | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(table, row numbers, codes): for norm None the `probes` best codes of each row, else the one it is kept under."""
    size = _size(x.shape[1])
    y, signs = lifted(x, size, norm), rotations(size, tables, hashes)
    for t in range(tables):
        close = [axes(y, signs[t, h]) for h in range(hashes)]
        if norm is not None:
            code = np.zeros(len(x), np.int64)
            for c in close:
                code = code * 2 * size + c.argmax(axis=1)
            yield t, np.arange(len(x)), code
            continue
        few = min(2 * size, probes)
        best = [np.argsort(-c, axis=1, kind="stable")[:, :few] for c in close]
        lost = [np.take_along_axis(c, b, axis=1) for c, b in zip(close, best, strict=True)]
        choices = [p for p in product(range(few), repeat=hashes) if np.prod(np.array(p) + 1) <= probes]  # no other can be among the best
        codes, total = np.zeros((len(x), len(choices)), np.int64), np.zeros((len(x), len(choices)))
        for h in range(hashes):
            pick = [p[h] for p in choices]
            codes, total = codes * 2 * size + best[h][:, pick], total + (lost[h][:, :1] - lost[h][:, pick]) ** 2
        order = np.argsort(total, axis=1, kind="stable")[:, :probes]
        yield t, np.repeat(np.arange(len(x)), order.shape[1]), np.take_along_axis(codes, order, axis=1).ravel()


def usable(vector: str) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & whole & F.exists(vector, lambda x: x != 0), F.lit(False))


ROW = "a long, b long, vector array<double>"


def _keys(vectors: DataFrame, tables: int, hashes: int, probes: int, norms: dict[tuple[int, int], float], query: bool) -> DataFrame:
    """(a, b, dims, class, vector) to (key, a, b, vector) for each table, and for queries each probe and class."""

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            a, b, dims, classes = (batch.column(k).to_numpy() for k in range(4))
            flat, ends = batch.column(4).flatten().to_numpy(), batch.column(4).offsets.to_numpy()
            for d, c in sorted({*zip(dims.tolist(), classes.tolist(), strict=True)}):
                at = np.flatnonzero((dims == d) & (classes == c))
                x = flat[(ends[at] - ends[0])[:, None] + np.arange(d)]
                for t, rows, codes in hash_rows(x, tables, hashes, probes, None if query else norms[d, c]):
                    for k in [k for n, k in norms if n == d] if query else [c]:
                        key = [f"{d}:{k}:{t}:{code}" for code in codes.tolist()]
                        for i in range(0, len(rows), 2048):
                            r = rows[i : i + 2048]
                            vectors = pa.ListArray.from_arrays(np.arange(0, (len(r) + 1) * d, d, dtype=np.int32), x[r].ravel())
                            yield [key[i : i + 2048], a[at[r]], b[at[r]], vectors]

        return work

    return map_rows(vectors.select("a", "b", "dims", "class", "vector"), make, f"key string, {ROW}")


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)


def _compare(top: int) -> Callable:
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [], [], [], [], []
        if len(left) and len(right):
            x, y = _matrix(left), _matrix(right)
            ids = [table.column(c).to_numpy() for table in (left, right) for c in "ab"]
            for i in range(0, len(x), 256):
                score = x[i : i + 256] @ y.T
                keep = min(top, len(y))
                cut = np.partition(score, len(y) - keep, axis=1)[:, len(y) - keep]
                r, c = np.nonzero(score >= cut[:, None])  # with all ties
                for column, values in zip(out, (ids[0][i + r], ids[1][i + r], ids[2][c], ids[3][c], score[r, c]), strict=True):
                    column.append(values)
        return pa.table({n: pa.array(np.concatenate(v) if v else [], k) for n, v, k in zip(("qa", "qb", "a", "b", "score"), out, (pa.int64(),) * 4 + (pa.float64(),), strict=True)})

    return best


def nearest(vectors: DataFrame, every: int = 20, top: int = TOP, tables: int = TABLES, probes: int = PROBES, most_hashes: int = 1) -> DataFrame:
    """vectors (vec_id, embedding) to (query_id, rank, vec_id, score): the `top` nearest rows found of each whose id `every` divides.

    Nearest first, ties to the smaller id, never a query's own id; fewer where there are fewer. Vectors of other lengths are
    no candidates. Keys hold up to most_hashes axes, as BUCKET wants; over one, recall falls unless tables and probes rise with it. Null ids and vectors that usable() refuses take no part; of rows that repeat an id with its vector one counts.
    """
    rows = need(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).where("vec_id is not null").where(usable("vector"))
    rows = rows.select("vec_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b"), "vector")
    # no more than the top + 1 smallest ids of a vector can be among the nearest of any query
    ranked = rows.dropDuplicates(["vec_id", "a", "b"]).withColumn("nth", F.row_number().over(W.partitionBy("a", "b").orderBy("vec_id"))).where(F.col("nth") <= top + 1)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    kept = ranked.groupBy("a", "b").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    kept = written(kept.withColumn("norm", norm).withColumn("dims", F.size("vector")).withColumn("class", F.floor(F.log2("norm")).cast("int")), "vectors")
    norms = {(r["dims"], r["class"]): r["m"] for r in kept.groupBy("dims", "class").agg(F.max("norm").alias("m"), F.count("*").alias("n")).collect()}  # a class is a power of two
    n, largest = kept.count(), max((d for d, _ in norms), default=1)
    hashes = max(1, min(most_hashes, round(log(max(n, 1) / BUCKET) / log(2 * _size(largest))))) if n else 1
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "a", "b").distinct()
    queries = kept.join(asked.select("a", "b").distinct(), ["a", "b"], "left_semi")

    index, probed = _keys(kept, tables, hashes, probes, norms, False), _keys(queries, tables, hashes, probes, norms, True)
    counts = index.groupBy("key").agg(F.count("*").alias("n")).join(probed.groupBy("key").agg(F.count("*").alias("m")), "key").select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("left"), F.ceil(F.col("m") / CHUNK).cast("int").alias("right"))
    counts = written(counts, "buckets")
    part = F.pmod(F.col("a"), F.col("left")), F.pmod(F.col("a"), F.col("right"))
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    index = index.join(counts, "key").select("key", part[0].cast("int").alias("i"), each("right").alias("j"), "a", "b", "vector")
    probed = probed.join(counts, "key").select("key", each("left").alias("i"), part[1].cast("int").alias("j"), "a", "b", "vector")
    bounded_batches(vectors.sparkSession)
    found = probed.groupBy("key", "i", "j").cogroup(index.groupBy("key", "i", "j")).applyInArrow(_compare(top + 1), "qa long, qb long, a long, b long, score double")
    found = found.groupBy("qa", "qb", "a", "b").agg(F.max("score").alias("score"))
    found = found.withColumn("nth", F.rank().over(W.partitionBy("qa", "qb").orderBy(F.desc("score")))).where(F.col("nth") <= top + 1)
    found = found.join(kept.select("a", "b", "ids"), ["a", "b"]).select("qa", "qb", "score", F.explode("ids").alias("vec_id"))
    found = found.withColumn("nth", F.row_number().over(W.partitionBy("qa", "qb").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= top + 1)
    lists = found.groupBy("qa", "qb").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("near"))  # top + 1 at most
    out = asked.join(lists, (F.col("a") == F.col("qa")) & (F.col("b") == F.col("qb"))).select(F.col("vec_id").alias("query_id"), F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, top).alias("near"))
    return out.select("query_id", F.posexplode("near").alias("k", "x")).select("query_id", (F.col("k") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
