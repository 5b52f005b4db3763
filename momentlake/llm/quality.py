"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of word n-grams and of shape n-grams (a shape keeps a word's
case pattern and its symbols; a word that repeats the one before has a shape of its own), hashed
into a fixed space.  Indicators are scaled by the log-count ratio of their classes, and a linear model
with hinge loss is fitted to them by dual coordinate descent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentlake.llm.common import gram_hashes, hashed_words, mixed, shared_table

#: Hashed features of words and, after them, of shapes.
WORD_FEATURES, SHAPE_FEATURES = 1 << 18, 1 << 16
WORD_GRAMS, SHAPE_GRAMS = (1, 2), (1, 2, 3)
#: Labelled rows that are fitted to at most, those with the smallest hashes of their id.
MAX_ROWS = 20_000

#: Longest word whose shape is remembered.
KEPT_BYTES = 64

_RUNS = (re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[^\W\d_X]+"), re.compile(r"\d+"))


class ShapeHashes(dict):
    """Hashes of word shapes: runs of capitals X, of other letters x, of digits 0, symbols as they are.

    Remembers a bounded number of words of usual length.
    """

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        shape = word.decode("utf-8", "replace")
        for run, sign in zip(_RUNS, "Xx0", strict=True):
            shape = run.sub(sign, shape)
        value = xxhash.xxh64_intdigest(shape)
        if len(word) <= KEPT_BYTES:
            self[word] = value
        return value


class Features:
    """The features of texts; keeps the hashes of shapes from text to text."""

    def __init__(self) -> None:
        self.shapes = ShapeHashes()

    def of(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Sorted distinct feature numbers of each text; none for null, empty and blank ones."""
        for text, words in zip(texts, hashed_words(texts), strict=True):
            yield self._one(text if isinstance(text, str) else "", words)

    def _one(self, text: str, words: np.ndarray) -> np.ndarray:
        shapes = np.fromiter(map(self.shapes.__getitem__, text.encode("utf-8", "surrogatepass").split()), np.uint64, len(words))
        shapes[1:][words[1:] == words[:-1]] = 1
        found = [(gram_hashes(words, k) + np.uint64(k)) % np.uint64(WORD_FEATURES) for k in WORD_GRAMS]
        found += [np.uint64(WORD_FEATURES) + (mixed(gram_hashes(shapes, k) + np.uint64(k))) % np.uint64(SHAPE_FEATURES) for k in SHAPE_GRAMS]
        return np.unique(np.concatenate(found)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Weights by feature (log-count ratio times the fitted weight; 0 for features never seen) and the bias."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    steepness: float

    def margin(self, features: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratios[features]).sum())) or 1.0
        return float(self.weights[features].sum()) / norm + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-self.steepness * np.clip(self.margin(features), -50, 50))))


def log_count_ratios(rows: list[np.ndarray], label: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of the smoothed shares that a feature has of the indicators of class 1 and of class 0."""
    size = WORD_FEATURES + SHAPE_FEATURES
    counts = np.zeros((2, size))
    for features, y in zip(rows, label, strict=True):
        counts[int(y), features] += 1
    shares = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.where(counts.sum(axis=0) > 0, np.log(shares[1] / shares[0]), 0.0)


def dual_coordinate_descent(
    rows: list[np.ndarray], label: np.ndarray, ratios: np.ndarray, *, cost: float = 1.0, passes: int = 12, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Hinge-loss linear model over unit rows of scaled indicators and a constant.

    Each step sets one dual variable to its best value in [0, cost of its class]; classes
    weigh alike.  Stops when no step of a pass moves far.
    """
    sign = np.where(label == 1, 1.0, -1.0)
    share = np.bincount((label == 1).astype(int), minlength=2)
    most = np.where(label == 1, cost * len(label) / (2 * max(share[1], 1)), cost * len(label) / (2 * max(share[0], 1)))
    # Rows stay feature numbers; their scaled values are looked up at each step.
    norms = np.array([float(np.sqrt(np.square(ratios[f]).sum())) or 1.0 for f in rows])
    squares = np.array([1.0 + float(np.square(ratios[f]).sum()) / n**2 for f, n in zip(rows, norms, strict=True)])
    weights, bias, dual = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    shuffle = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in shuffle.permutation(len(rows)):
            value = ratios[rows[i]] / norms[i]
            slope = sign[i] * (float(weights[rows[i]] @ value) + bias) - 1
            step = min(max(dual[i] - slope / squares[i], 0.0), most[i]) - dual[i]
            if step:
                dual[i] += step
                weights[rows[i]] += step * sign[i] * value
                bias += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def fit(labelled: DataFrame, *, cost: float = 1.0, steepness: float = 4.0) -> Model:
    """Model of ``labelled`` (doc_id, text, label 0 or 1; already bounded by ``sample``).

    Tasks make the features; the rows, as many as the caller's sample has, meet in one
    place, where the descent runs.  With one class or no rows all weights are 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "f": [f.tobytes() for f in features.of(batch["text"])]})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = pd.DataFrame({"doc_id": [], "label": [], "f": []})
        got = pd.concat([none, *batches], ignore_index=True).sort_values(["doc_id", "label", "f"])
        rows, label = [np.frombuffer(f, np.int32) for f in got["f"]], got["label"].to_numpy()
        if len(set(label)) < 2:
            return
        ratios = log_count_ratios(rows, label)
        weights, bias = dual_coordinate_descent(rows, label, ratios, cost=cost)
        yield pd.DataFrame({"ratios": [ratios.astype("f4").tobytes()], "weights": [(weights * ratios).astype("f4").tobytes()], "bias": [bias]})

    size = WORD_FEATURES + SHAPE_FEATURES
    # Written, so that no task holds two Python workers at once.
    made = shared_table(labelled.select("doc_id", "text", "label").mapInPandas(run, "doc_id long, label int, f binary"))
    # One task on purpose: no more rows than the sample.
    solved = made.coalesce(1).mapInPandas(solve, "ratios binary, weights binary, bias double").collect()
    if not solved:
        return Model(np.zeros(size, "f4"), np.zeros(size, "f4"), 0.0, steepness)
    one = solved[0]
    return Model(np.frombuffer(one["ratios"], "f4"), np.frombuffer(one["weights"], "f4"), one["bias"], steepness)


def sample(docs: DataFrame, labels: DataFrame, *, label: str, usable: Column, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, label) of the ``max_rows`` labelled usable ids with the smallest hashes.

    An id with several labels takes the smallest, one with several texts the least; null ids and
    labels are left out.  The ids are bounded, so they are broadcast and only their texts are shuffled.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(usable)
    ids = ids.groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced.

    Null, empty and blank texts have the score of the bias alone; equal texts score alike, repeated rows each; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the feature space

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for batch in texts:
            yield pd.Series([shared.value.score(f) for f in features.of(batch)], dtype="float64")

    rows = docs.drop(*[c for c in docs.columns if c in ("score", "predicted")]).withColumn("score", scored(F.col("text")))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def classify(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` scored by a model of the labelled rows that are not held out."""
    training = sample(docs, labels, label=label, usable=~held_out(F.col("doc_id")), max_rows=max_rows)
    return score(docs, fit(training))
