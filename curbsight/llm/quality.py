"""Quality classifier: naive Bayes support vectors.

Features are indicators of byte n-grams (1 to 3 bytes, hashed) of the whole text between two end marks, so that an
empty text has a feature as well, and of n-grams of equal words. Each is scaled by its class log-count ratio (naive Bayes), the row to unit length, and a
linear hinge-loss model is fitted by dual coordinate descent. Margins become scores by a logistic curve fitted to
out-of-fold margins, so 0.7 means about seven in ten.

The fit uses at most ``SAMPLE_ROWS`` labelled rows (those with the smallest hash of their id, so every label has
the same chance); everything else covers all documents. Labels are read from rows whose crc32(doc_id as text)
modulo 4 is not 2; the others are held out. Of repeated labels of an id the smaller counts, null ids and null
labels are ignored; a repeated document counts once per row. If only one class is labelled, every document gets
the smoothed share of that class, with no labels at all 0.5. Null texts count as empty. Extra columns are kept.
"""

from __future__ import annotations

import bisect
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import stored

SAMPLE_ROWS = 8_000
FEATURES = 1 << 18
FOLDS = 3
EPOCHS = 20
COST = 1.0
THRESHOLD = 0.7

_SPREAD = np.uint32(2654435761)
_PAIRS = 1 << 16
#: Indicators of a word that stands several times in a row: an n-gram of equal words, whichever they are.
_IN_A_ROW = (2, 3, 5, 9, 17)
_TRIPLES = FEATURES - _PAIRS - 256 - len(_IN_A_ROW)


class Indicators:
    """The features of a text, each once, in ascending order."""

    def __init__(self) -> None:
        self.seen = np.zeros(FEATURES, np.bool_)

    def of(self, text: str | None) -> np.ndarray:
        plain = (text or "").encode()
        words = plain.split()
        alike = bytes(map(operator.eq, words, words[1:]))
        longest = 1 + max(map(len, alike.split(b"\0")))
        raw = np.frombuffer(b"\x02" + plain + b"\x03", np.uint8).astype(np.uint32)
        pairs = raw[:-1] << 8 | raw[1:]
        triples = (pairs[:-1] << 8 | raw[2:]) * _SPREAD >> np.uint32(8)
        self.seen[raw + _PAIRS] = True
        self.seen[pairs] = True
        self.seen[triples % np.uint32(_TRIPLES) + np.uint32(_PAIRS + 256)] = True
        self.seen[FEATURES - bisect.bisect_right(_IN_A_ROW, longest):] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass
class Model:
    """``weights`` are those of the support vectors times the log-count ratios; rows have unit length in ``ratios``."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        ratios = self.ratios[found]
        norm = float(np.sqrt(ratios @ ratios)) or 1.0
        return float(self.weights[found] @ ratios) / norm + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of how much likelier each feature is in class 1.

    One count is added, shared out as the classes are, so a feature that was never seen speaks for neither.
    """
    shares = []
    for label in (0, 1):
        own = labels == label
        counts = np.full(FEATURES, own.mean())
        for i in np.flatnonzero(own):
            counts[rows[i]] += 1
        shares.append(counts / own.sum())
    return np.log(shares[1]) - np.log(shares[0])


def dual_descent(rows: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model; one dual variable per row is moved to its optimum at a time.

    A row's values are the ratios of its features, brought to unit length. They are looked up when the row's turn
    comes, so only the features of the sample are held.
    """
    length = np.array([np.sqrt(ratios[f] @ ratios[f]) or 1.0 for f in rows])
    sign = np.where(labels == 1, 1.0, -1.0)
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(FEATURES), 0.0
    order = np.arange(len(rows))
    shuffle = np.random.default_rng(7)
    for _ in range(EPOCHS):
        shuffle.shuffle(order)
        worst = 0.0
        for i in order.tolist():
            found = rows[i]
            value = ratios[found] / length[i]
            slope = sign[i] * (weights[found] @ value + bias) - 1
            moved = min(max(alpha[i] - slope / 2, 0.0), COST) - alpha[i]  # rows have unit length, and the bias
            if moved:
                alpha[i] += moved
                weights[found] += moved * sign[i] * value
                bias += moved * sign[i]
                worst = max(worst, abs(moved))
        if worst < 1e-3:
            break
    return weights, bias


def _fitted(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    ratios = log_count_ratios(rows, labels)
    weights, bias = dual_descent(rows, ratios, labels)
    return Model(ratios, weights, bias, 1.0, 0.0)


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that fits the labels best, with smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    point = np.array([1.0, float(np.log((n1 + 1) / (n0 + 1)))])
    design = np.stack([margins, np.ones(len(margins))], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ point, -30, 30)))
        gradient = design.T @ (p - target) + 1e-6 * point
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        point -= step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(point[0]), float(point[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    n, positive = len(labels), int(labels.sum())
    if positive in (0, n):
        share = (positive + 1) / (n + 2)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    folds = np.empty(n, int)
    for label in (0, 1):  # every fold gets its part of both classes
        own = np.flatnonzero(labels == label)
        folds[own] = np.arange(len(own)) % FOLDS
    margins = np.zeros(n)
    for fold in range(FOLDS):
        train, test = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
        if 0 < labels[train].sum() < len(train):
            model = _fitted([rows[i] for i in train], labels[train])
            margins[test] = [model.margin(rows[i]) for i in test]
    model = _fitted(rows, labels)
    model.slope, model.shift = logistic(margins, labels.astype(float))
    return model


# --- on Spark --------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and label of the sample, as a stored table of at most ``SAMPLE_ROWS`` ids."""
    usable = labels.where(~held_out(F.col("doc_id"))).where("quality in (0, 1) and doc_id is not null")
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)

    @F.pandas_udf("array<int>")
    def features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        indicators = Indicators()
        for batch in texts:
            yield pd.Series([indicators.of(t).astype(np.int32) for t in batch])

    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most SAMPLE_ROWS ids
    return stored(joined.select("doc_id", "label", features("text").alias("features")), "quality-sample")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit in one task on the bounded sample; the driver receives the weights."""
    schema = "ratios binary, weights binary, bias double, slope double, shift double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        frame = pd.concat(parts) if parts else pd.DataFrame({"doc_id": [], "label": [], "features": []})
        frame = frame.sort_values("doc_id", kind="stable")
        model = fit([np.asarray(f, np.int32) for f in frame["features"]], frame["label"].to_numpy(np.int64))
        yield pd.DataFrame({"ratios": [model.ratios.tobytes()], "weights": [model.weights.tobytes()],
                            "bias": [model.bias], "slope": [model.slope], "shift": [model.shift]})

    row = training_rows(docs, labels).coalesce(1).mapInPandas(run, schema).first()
    if row is None:
        return fit([], np.zeros(0, np.int64))
    return Model(np.frombuffer(row["ratios"]), np.frombuffer(row["weights"]), row["bias"], row["slope"], row["shift"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on), which replace columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers per hashed feature

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        indicators, model = Indicators(), shared.value
        for batch in texts:
            yield pd.Series([model.score(indicators.of(t)) for t in batch], dtype="float64")

    scored = docs.drop("score", "predicted").withColumn("score", scores(F.coalesce("text", F.lit(""))))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
