"""Toxicity scores by a counterfactually regularised linear classifier."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import mapped, packed, pick, staged, table, unpacked

THRESHOLD = 0.3
# At most so many labelled rows of each class are learnt from, those of the least hash.
ROWS_A_CLASS = 4096
FEATURES = 2048
# Features whose chi-square is less than this are taken for chance.
LEAST_CHI = 15.0
PREFIXES = (4, 5, 6)
RIDGE = 0.001
FAIRNESS = 1.0
STEPS = 400
# Distinct words a worker remembers; then it starts again.
REMEMBERED = 100_000

# Terms that name groups of people. Terms of one row are swapped with each other.
IDENTITIES = (
    "women men girls boys",
    "woman man girl boy",
    "female male",
    "mother father",
    "muslim christian jewish hindu buddhist atheist catholic",
    "muslims christians jews hindus buddhists atheists catholics",
    "black white asian hispanic latino african",
    "gay straight lesbian bisexual queer transgender heterosexual",
    "american mexican chinese indian russian german french turkish",
    "immigrant refugee foreigner citizen",
    "immigrants refugees foreigners citizens",
    "disabled deaf blind autistic",
    "old young elderly",
)

_WORD = re.compile(r"[^\W\d_]+")
_SWAP = {
    word: row.split()[(k + 1) % len(row.split())]
    for row in IDENTITIES
    for k, word in enumerate(row.split())
}


def word_features(word: str) -> list[int]:
    """The word and its first letters, hashed."""
    keys = [f"={word}"] + [f"^{word[:n]}" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(key.encode()) for key in keys]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def text_features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([f for w in words for f in word_features(w)], "<u4"))


def swapped(words: set[str]) -> set[str] | None:
    """The words with every identity term swapped for another, or None without such a term."""
    if words.isdisjoint(_SWAP):
        return None
    return {_SWAP.get(word, word) for word in words}


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]

    def scores(self, texts: list[str | None], memory: dict[str, tuple]) -> list[float]:
        """``memory`` holds the known features of words seen before."""
        out = []
        for text in texts:
            if len(memory) > REMEMBERED:
                memory.clear()
            words = words_of(text)
            for word in words.difference(memory):
                memory[word] = tuple(f for f in word_features(word) if f in self.weights)
            found = set().union(*filter(None, map(memory.__getitem__, words)))
            # Sorted: the sum does not depend on the order of a set.
            total = self.bias + sum(self.weights[f] for f in sorted(found))
            out.append(float(1 / (1 + np.exp(-np.clip(total, -60, 60)))))
        return out


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows of this remainder are never learnt from. A null id is held out."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Features of the training rows, with those after the swap, and the size of each class."""
    labels = pick(labels, "doc_id", "toxic")
    known = labels.where(F.col("toxic").isNotNull() & ~is_held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    chosen = reduce(
        DataFrame.union,
        [known.where(f"toxic = {c}").orderBy(*order).limit(ROWS_A_CLASS) for c in (0, 1)],
    )
    # Bounded by the two limits: 8,192 pairs of numbers.
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), "text")
    rows = rows.join(F.broadcast(chosen), "id")
    # One row an id, however often it comes: that of the least hash.
    rows = rows.groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.select("toxic", "text", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words_of(x) for x in batch.column(1).to_pylist()]
            other = [swapped(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([text_features(x).tobytes() for x in found], pa.binary()),
                    pa.array([x and text_features(x).tobytes() for x in other], pa.binary()),
                    batch.column(2),
                ],
                ["toxic", "features", "swapped", "id"],
            )

    made = mapped(rows, run, "toxic int, features binary, swapped binary, id long")
    return staged(made, "toxicity-rows"), sizes


def _best(made: DataFrame, n: int, p: int) -> np.ndarray:
    """The features, sorted, that tell the classes apart best by chi-square.

    Counted where the rows are: only the chosen features reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()]
            names, codes = np.unique(np.concatenate(vectors), return_inverse=True)
            label = np.repeat(batch.column(0).to_numpy(), [len(v) for v in vectors])
            positive = np.bincount(codes, weights=label, minlength=len(names))
            total = np.bincount(codes, minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.astype("<i8")), pa.array(positive), pa.array(total.astype("f8"))],
                ["feature", "positive", "total"],
            )

    counts = mapped(made.select("toxic", "features"),
        run, "feature long, positive double, total double"
    )
    counts = counts.groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("total").alias("total"))
    total, expected = F.col("total"), F.col("total") * p / n
    chi = (F.col("positive") - expected) ** 2 / (
        expected * (1 - p / n) * (1 - total / (n + 1)) + 1e-9
    )
    # Equal ones by their number. Features of one row come last.
    known = counts.where(total >= 2).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
    found = known.orderBy(F.desc("chi"), "feature").limit(FEATURES).select("feature").collect()
    return np.array(sorted(r[0] for r in found), "<u4")


def _taken(made: DataFrame, best: np.ndarray) -> list:
    """The rows with what they have of the chosen features."""
    sent = made.sparkSession.sparkContext.broadcast(best)

    def kept(features: bytes | None) -> bytes | None:
        return features and np.intersect1d(np.frombuffer(features, "<u4"), sent.value, True).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(list(map(kept, batch.column(k).to_pylist())), pa.binary()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, batch.column(3)], batch.schema.names
            )

    taken = mapped(made, run, made.schema).collect()
    return sorted(taken, key=lambda r: (r["id"], r["features"]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from at most ``ROWS_A_CLASS`` labelled texts of each class.

    A logistic regression on whether words and word beginnings occur. Swapping
    identity terms must not move a score: the squared change, over the texts
    that name a group and over the bare terms, is added to the loss.
    Classes are weighted back to their sizes among all labels. Without rows of
    both classes every text gets the share of label 1 (0 without labels).
    """
    made, sizes = _sample(docs, labels)
    met = {r[0]: r[1] for r in made.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sizes.get(0, 0) + sizes.get(1, 0))
    if len(met) < 2:
        return Model(float(np.log((share + 1e-6) / (1 - share + 1e-6))), {})

    n, p = sum(met.values()), met[1]
    best = _best(made, n, p)
    rows = _taken(made, best)
    target = np.array([float(r["toxic"]) for r in rows])
    vectors = [np.frombuffer(r["features"], "<u4") for r in rows]
    owner = np.repeat(np.arange(n), [len(v) for v in vectors])
    x = np.zeros((n, len(best)), np.float32)
    x[owner, np.searchsorted(best, np.concatenate(vectors))] = 1

    def row_of(features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(best), np.float32)
        out[np.searchsorted(best, np.intersect1d(features, best, True))] = 1
        return out

    change = [
        x[k] - row_of(np.frombuffer(r["swapped"], "<u4"))
        for k, r in enumerate(rows)
        if r["swapped"] is not None
    ]
    change += [row_of(text_features({a})) - row_of(text_features({b})) for a, b in _SWAP.items()]
    change = np.array(change, float)

    weight = np.where(target == 1, share / max(p, 1), (1 - share) / max(n - p, 1))
    # Both classes count, also where one is rare.
    weight = weight / 2 + np.where(target == 1, 0.5 / p, 0.5 / (n - p)) / 2
    w, bias = np.zeros(len(best)), float(np.log(share / (1 - share)))
    speed_w, speed_b = np.zeros_like(w), 0.0
    # The largest curvature, by power iteration, sets the step.
    probe, curve = np.ones(len(best) + 1), 0.0
    for _ in range(30):
        probe /= max(np.linalg.norm(probe), 1e-12)
        spread = 0.25 * weight * (x @ probe[:-1].astype("f4") + probe[-1])
        pull = 2 * FAIRNESS * (change.T @ (change @ probe[:-1])) / len(change)
        probe = np.append(x.T @ spread.astype("f4") + pull, spread.sum())
        curve = np.linalg.norm(probe)
    curve = 1.1 * curve + RIDGE
    for step in range(STEPS):
        momentum = step / (step + 3)
        ahead_w, ahead_b = w + momentum * speed_w, bias + momentum * speed_b
        error = weight * (1 / (1 + np.exp(-(x @ ahead_w.astype("f4") + ahead_b))) - target)
        slope = x.T @ error.astype("f4") + RIDGE * ahead_w
        slope += 2 * FAIRNESS * (change.T @ (change @ ahead_w)) / len(change)
        new_w, new_b = ahead_w - slope / curve, ahead_b - error.sum() / curve
        speed_w, speed_b, w, bias = new_w - w, new_b - bias, new_w, new_b
    return Model(float(bias), {int(f): float(v) for f, v in zip(best, w) if v})


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; null texts count as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict[str, tuple] = {}
        for part in texts:
            yield pd.Series(sent.value.scores(part.tolist(), memory), dtype="float64")

    return docs.withColumn(name, score(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) may repeat ids (the largest label counts), miss
    ids or be empty. Scores use nothing but the text: repeated rows and equal
    texts score alike, a null text like an empty one. Null ids are kept.
    """
    scored = with_score(pick(docs, "doc_id", "text"), fit(docs, labels), "score")
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold; all columns as they are."""
    scored = with_score(packed(docs, "text"), fit(docs, labels), "score")
    return unpacked(scored.where(F.col("score") < threshold), docs)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
