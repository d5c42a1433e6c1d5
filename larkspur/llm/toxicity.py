"""A toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and their first letters. Its loss adds, for labelled texts that name a group of
people, the squared change of the logit when the name is swapped for that of another group; a name alone then carries no
weight, and neutral mentions of groups that the labelled data often insult are not taken for toxic.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, need, written

SAMPLE = 8_000  # labelled texts to learn from at most, those of smallest hashed id
LEAST_TEXTS, LEAST_Z = 5, 4.0  # a feature is kept where so many labelled texts have it, and labels differ on it so much
PENALTY, RIDGE, LASSO, STEPS = 4.0, 1e-4, 2e-4, 300
CACHE = 400_000
PREFIXES = (3, 4, 5)

# Names of groups of people in the four languages; a name is swapped for another of its line.
IDENTITIES = (
    "women men girls boys",
    "woman man girl boy",
    "muslims christians jews hindus buddhists atheists catholics sikhs",
    "muslim christian jewish hindu buddhist atheist catholic sikh",
    "black white asian latino african european arab indian",
    "gay straight lesbian bisexual transgender queer",
    "immigrants refugees migrants foreigners natives locals",
    "disabled deaf blind elderly young old",
    "frauen männer mädchen jungen",
    "muslime christen juden hindus buddhisten atheisten",
    "ausländer flüchtlinge migranten einheimische",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs hindous bouddhistes athées",
    "étrangers réfugiés migrants immigrés",
    "mujeres hombres niñas niños",
    "musulmanes cristianos judíos hindúes budistas ateos",
    "extranjeros refugiados migrantes inmigrantes",
)
GROUPS: dict[str, tuple[str, ...]] = {}
for _line in IDENTITIES:
    for _w in _line.split():
        GROUPS.setdefault(_w, tuple(x for x in _line.split() if x != _w))
_PARTS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text, in lower case, split at white space; null: none."""
    return set((text or "").lower().split())


def features_of(word: str) -> list[str]:
    """A word's parts of letters and digits, each whole and by its first letters."""
    return [f for p in _PARTS.findall(word) for f in (f"={p}", *(p[:k] for k in PREFIXES if len(p) >= k))]


def text_features(words: set[str]) -> list[str]:
    return sorted({f for w in words for f in features_of(w)})


def counterfactuals(words: set[str]) -> list[set[str]]:
    """The words with one group's name replaced by that of another group, for each word with such a name and each other group of its line."""
    named = sorted((p, w) for w in words for p in set(_PARTS.findall(w)) if p in GROUPS)
    return [words - {w} | {w.replace(p, q)} for p, w in named for q in GROUPS[p]]


@dataclass
class Model:
    """Weights by feature; `bias` is the logit of a text without any."""

    bias: float
    weights: dict[str, float]

    def logit(self, words: set[str]) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in text_features(words))

    def score(self, text: str | None) -> float:
        return 1 / (1 + exp(-max(-500.0, min(500.0, self.logit(words_of(text))))))


class _Sparse:
    """Rows of places and values, as one array each, with products by vectors from both sides."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.width, self.height = width, len(rows)
        self.at = np.concatenate([a for a, _ in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
        self.values = np.concatenate([v for _, v in rows]).astype(float) if rows else np.zeros(0)
        self.row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * v[self.at], self.height)

    def turned(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.values * r[self.row], self.width)


def fit(labels: np.ndarray, texts: list[np.ndarray], swaps: list[tuple[np.ndarray, np.ndarray, float]], vocabulary: list[str], penalty: float = PENALTY) -> Model:
    """Labels, texts as places in the vocabulary, and swaps to a model, by proximal gradient steps of one length.

    A swap is a change of features (places, +1 or -1) with how often it occurs among all counterfactuals, so that their number
    does not matter. Without both labels the score is a constant: the smoothed share of label 1.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        share = (float(y.sum()) + 0.1) / (len(y) + 1.0)
        return Model(log(share / (1 - share)), {})
    n = len(vocabulary)
    x, d = _Sparse([(a, np.ones(len(a))) for a in texts], n), _Sparse([(a, v) for a, v, _ in swaps], n)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both labels count alike
    often = np.array([c for _, _, c in swaps], float)
    pull = 2 * penalty * often / often.sum() if len(often) else often

    def curvature(of: Callable, size: int) -> float:
        """The largest eigenvalue, by power iteration."""
        u, found = np.ones(size), 0.0
        for _ in range(30):
            u = of(u)
            found = float(np.linalg.norm(u))
            if not found:
                break
            u /= found
        return found

    def quadratic(u: np.ndarray) -> np.ndarray:
        r = weight / 4 * (x.times(u[:-1]) + u[-1])
        return np.append(x.turned(r), r.sum())

    def swapped(u: np.ndarray) -> np.ndarray:
        return d.turned(pull * d.times(u))

    step = 1 / (1.05 * (curvature(quadratic, n + 1) + curvature(swapped, n)) + RIDGE)
    w, b, v, c, k = np.zeros(n), 0.0, np.zeros(n), 0.0, 1.0
    for _ in range(STEPS):
        r = weight * (1 / (1 + np.exp(-np.clip(x.times(v) + c, -50, 50))) - y)
        w2, b2 = v - step * (x.turned(r) + RIDGE * v + swapped(v)), c - step * float(r.sum())
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * LASSO, 0)
        k2 = (1 + (1 + 4 * k * k) ** 0.5) / 2
        v, c = w2 + (k - 1) / k2 * (w2 - w), b2 + (k - 1) / k2 * (b2 - b)
        w, b, k = w2, b2, k2
    return Model(float(b), {f: float(z) for f, z in zip(vocabulary, w, strict=True) if z})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = PENALTY) -> Model:
    """docs (doc_id, text) and labels (doc_id, toxic 0 or 1) to a model, from up to `sample` labelled texts outside the held-out fold.

    Labels other than 0 and 1, and null ids, are left out; of texts that occur again one counts, and a null one has no words.
    Features, few of which pass LEAST_TEXTS and LEAST_Z, are not cut further. Each other group of a name's line makes a
    counterfactual; equal changes count together, so that the driver holds a row for each text and each pair of names at most.
    """
    labels = need(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    chosen = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = need(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text").alias("same")).agg(F.min_by(F.struct("doc_id", "toxic", "text"), "doc_id").alias("row")).select("row.*")

    def make() -> Callable:
        def work(batch) -> Iterator[list]:
            found = [words_of(t) for t in batch.column(2).to_pylist()]
            swapped = [[text_features(x) for x in counterfactuals(w)] for w in found]
            yield [batch.column(0), batch.column(1), [text_features(w) for w in found], swapped]

        return work

    seen = written(map_rows(texts.select("doc_id", F.col("toxic").cast("int"), "text"), make, "doc_id long, toxic int, has array<string>, swapped array<array<string>>"), "sample")
    p, n = (seen.agg(F.sum("toxic"), F.count("*")).first()[k] or 0 for k in (0, 1))
    share = (F.col("a") + F.col("b")) / F.lit(float(max(n, 1)))
    z = (F.col("a") / max(p, 1) - F.col("b") / max(n - p, 1)) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / max(p, 1) + 1 / max(n - p, 1)))
    counts = seen.select(F.explode("has").alias("f"), "toxic").groupBy("f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    kept = counts.where(F.col("a") + F.col("b") >= LEAST_TEXTS).withColumn("z", z).where(F.abs("z") >= LEAST_Z)
    names = {f for g in GROUPS for f in features_of(g)}
    vocabulary = sorted({r["f"] for r in kept.select("f").collect()} | {r["f"] for r in counts.where(F.col("f").isin(sorted(names))).select("f").collect()})

    def cut() -> Callable:
        at = {f: k for k, f in enumerate(vocabulary)}

        def change(has: set[str], other: set[str]) -> list[int]:
            """Places of what a swap adds, and beyond the vocabulary those of what it takes away."""
            return sorted([at[f] for f in other - has if f in at] + [at[f] + len(at) for f in has - other if f in at])

        def work(batch) -> Iterator[list]:
            rows = batch.to_pylist()
            swaps = [[change(set(r["has"]), set(s)) for s in r["swapped"]] for r in rows]
            yield [batch.column(0), batch.column(1), [[at[f] for f in r["has"] if f in at] for r in rows], [[s for s in found if s] for found in swaps]]

        return work

    rows = map_rows(seen, cut, "doc_id long, toxic int, has array<int>, swaps array<array<int>>")
    changes = rows.select(F.explode("swaps").alias("change")).groupBy("change").agg(F.count("*").alias("n")).orderBy("change").collect()
    swaps = [(np.array(r["change"]) % len(vocabulary), np.where(np.array(r["change"]) < len(vocabulary), 1.0, -1.0), r["n"]) for r in changes]
    table = rows.drop("swaps").toArrow().sort_by("doc_id")  # `sample` rows at most
    return fit(table.column("toxic").to_numpy(), [np.asarray(x.values) for x in table.column("has")], swaps, vocabulary, penalty)


def held_out() -> F.Column:
    """Rows that no label is learned from: crc32 of the id's decimal text, modulo 5, is 0. Null ids: false."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


class _Known(dict):
    """Words to the features of the model that they bring; the words seen last stay, up to CACHE of them."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = tuple(f for f in features_of(word) if f in self.weights)
        return found


def _score(model: Model, known: _Known, text: str | None) -> float:
    hits: set[str] = set()
    for found in filter(None, map(known.__getitem__, words_of(text))):
        hits.update(found)
    z = model.bias + sum(map(model.weights.__getitem__, sorted(hits)))
    return 1 / (1 + exp(-max(-500.0, min(500.0, z))))


def scored(docs: DataFrame, model: Model, text: str = "text", row: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `row` of docs and a score from 0 to 1 of each whole text. Null and empty texts get the score of no words."""
    held = F.struct(*(F.col(f"`{c}`") for c in row)).alias("row")
    kind = docs.select(held).schema["row"].dataType.simpleString()

    def make() -> Callable:
        known = _Known(model.weights)

        def work(batch) -> Iterator[list]:
            yield [batch.column(0), [_score(model, known, t) for t in batch.column(1).to_pylist()]]

        return work

    out = map_rows(docs.select(held, F.col(f"`{text}`").alias("text")), make, f"row {kind}, score double")
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in row), "score")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs (text and any other columns) less the rows that score threshold or more. Rows stay as they are, in one pass.

    Null and empty texts have the score of no words; repeated rows and those with a null id are judged like any other; columns of
    any name, a score among them, stay. An empty table gives an empty one.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    text = docs.columns.index("text")

    def make() -> Callable:
        known = _Known(model.weights)

        def work(batch) -> Iterator[list]:
            keep = pa.array([_score(model, known, t) < threshold for t in batch.column(text).to_pylist()], pa.bool_())
            yield batch.filter(keep).columns

        return work

    return map_rows(docs, make, kinds)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
