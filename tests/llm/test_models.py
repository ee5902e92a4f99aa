"""The quality classifier and the language models."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbsight.llm import lm_scoring, quality
from tests.llm.conftest import ODD, documents, prose


def labelled(spark, n: int = 240):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(i, 20 + i % 60)
        rows.append((i, text if good else text.replace(" ", "$$$ ").upper()))
        labels.append((i, int(good), 0))
    return documents(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_judged_right_and_never_learnt(spark):
    docs, labels = labelled(spark)
    used = {r["doc_id"] for r in quality.training_rows(docs, labels).collect()}
    assert used == {i for i in range(240) if zlib.crc32(str(i).encode()) % 4 != 2}
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 240 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) == int(r["doc_id"] % 3 > 0) for r in got)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    again = quality.score(docs, quality.train(docs, flipped)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in got}


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 30)
    docs, labels = labelled(spark)
    assert quality.training_rows(docs, labels).count() == 30


@pytest.mark.parametrize("rows, share", [([], 0.5), ([(1, 1)], 2 / 3), ([(1, 0), (None, 1), (4, None)], 1 / 3)])
def test_labels_of_one_class(spark, rows, share):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    docs = documents(spark, ODD)
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(ODD) and all(r["score"] == pytest.approx(share) for r in got)


def test_dual_descent_reaches_the_optimum():
    draw = np.random.default_rng(0)
    rows = [np.sort(draw.choice(30, 6, replace=False)) for _ in range(80)]
    labels = np.array([int(3 in r or 7 in r) for r in rows])
    values = [np.full(6, 6 ** -0.5) for _ in rows]
    weights, bias = quality.dual_descent(rows, np.ones(quality.FEATURES), labels)

    def cost(w, b):
        margins = np.array([w[r] @ v + b for r, v in zip(rows, values)]) * np.where(labels == 1, 1, -1)
        return (w @ w + b * b) / 2 + quality.COST * np.maximum(0, 1 - margins).sum()

    best = cost(weights, bias)
    for _ in range(200):
        step = np.zeros(quality.FEATURES)
        step[:30] = draw.normal(0, 0.05, 30)
        assert cost(weights + step, bias + draw.normal(0, 0.05)) >= best * 0.995


def test_indicators_cover_the_whole_text():
    indicators = quality.Indicators()
    empty, short = indicators.of(None), indicators.of("a")
    assert len(empty) and set(empty.tolist()) != set(short.tolist())
    long = prose(1, 5000)
    assert set(indicators.of(long + " ☃").tolist()) - set(indicators.of(long).tolist())
    assert indicators.of("x x x")[-1] > quality.FEATURES - len(quality._IN_A_ROW)


# --- language models -------------------------------------------------------------------------


def bits_by_rule(rows, target, number):
    """Both cross-entropies of a row under models of all other rows, from dictionaries."""
    text = rows[number][1]
    counts: dict = {}
    for _, t in rows:
        for w in lm_scoring.tokens(t):
            counts[w] = counts.get(w, 0) + 1
    known = sorted(counts, key=lambda w: (-counts[w], w))[:lm_scoring.VOCABULARY]
    size = len(known) + 2

    def named(t):
        return ["<edge>", *(w if w in known else "<unknown>" for w in lm_scoring.tokens(t)), "<edge>"]

    sizes = {part: sum(len(named(t)) - 1 for i, t in rows if (i in target) == part) for part in (True, False)}
    out = []
    for part in (True, False):
        scale = min(sizes.values()) / sizes[part] if min(sizes.values()) else 1
        pairs: dict = {}
        before: dict = {}
        token: dict = {}
        for k, (i, t) in enumerate(rows):
            if (i in target) == part and k != number:
                w = named(t)
                for a, b in zip(w, w[1:]):
                    pairs[a, b] = pairs.get((a, b), 0) + 1
                    before[a] = before.get(a, 0) + 1
                    token[b] = token.get(b, 0) + 1
        total = sum(token.values())
        w = named(text)
        loss = [-math.log2((scale * pairs.get((a, b), 0)
                            + lm_scoring.PRIOR * (scale * token.get(b, 0) + 1) / (scale * total + size))
                           / (scale * before.get(a, 0) + lm_scoring.PRIOR)) for a, b in zip(w, w[1:])]
        out.append(sum(loss) / len(loss))
    return out


@pytest.mark.parametrize("vocabulary", [2000, 25])
def test_scores_are_those_of_the_models(spark, monkeypatch, vocabulary):
    monkeypatch.setattr(lm_scoring, "VOCABULARY", vocabulary)
    monkeypatch.setattr(lm_scoring, "HELD_TOKENS", 50)
    monkeypatch.setattr(lm_scoring.vocabulary, "__defaults__", (vocabulary,))
    rows = [*ODD, *((10 + i, prose(i, 3 + i % 50) + " *** !") for i in range(60))]
    labels = [(i, int(i % 2)) for i in range(0, 70)] + [(None, 1), (11, 1), (12, None)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    got = lm_scoring.cross_entropy_difference(documents(spark, rows, extra=True), frame, F.col("quality") == 1)
    target = {i for i, q in labels if q == 1 and i is not None}
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["target_bits"],
                    r["background_bits"], r["score"]) for r in got.collect())
    expected = []
    for k, (i, t) in enumerate(rows):
        a, b = bits_by_rule(rows, target, k)
        expected.append((i is not None, i or 0, len(lm_scoring.tokens(t)) + 1, a, b, a - b))
    assert len(found) == len(expected)
    for x, y in zip(found, sorted(expected)):
        assert x == pytest.approx(y)


def test_language_models_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert lm_scoring.cross_entropy_difference(documents(spark, []), labels, F.col("quality") == 1).count() == 0
    got = lm_scoring.cross_entropy_difference(documents(spark, ODD), labels, F.col("quality") == 1).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r["score"]) for r in got)


def test_all_tokens_are_told_apart_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 400)
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 1500)
    rows = [*ODD, *((10 + i, " ".join(f"w{i}x{j % 45} common" for j in range(50)) + " " + prose(i, i)) for i in range(70))]
    rows += [(90, "w3x1 common rare"), (91, "w3x1 common other")]  # differ in a word that is rare
    labels = spark.createDataFrame([(i, int(i % 2 or i == 90)) for i in range(91)] + [(33, 0)],
                                   "doc_id long, quality int")
    every = {t for _, text in rows for t in lm_scoring.tokens(text)}
    assert len(every) > 3000
    docs = documents(spark, rows).repartition(3)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["target_bits"], r["background_bits"])
                 for r in lm_scoring.cross_entropy_difference(docs, labels, F.col("quality") == 1).collect())
    monkeypatch.setattr(lm_scoring, "VOCABULARY", len(every))
    target = {i for i in range(91) if i % 2 or i == 90}
    expected = sorted((i is not None, i or 0, len(lm_scoring.tokens(t)) + 1, *bits_by_rule(rows, target, k))
                      for k, (i, t) in enumerate(rows) if i is None or i < 14 or i > 76)
    got = [r for r in got if not r[0] or r[1] < 14 or r[1] > 76]
    assert len(got) == len(expected)
    for x, y in zip(got, expected):
        assert x == pytest.approx(y)
    scores = {r[1]: r[3] for r in got}
    assert scores[90] != scores[91]


def test_a_document_is_not_judged_by_its_own_label(spark):
    """Forty texts of a kind: the score of one hardly depends on whether it is labelled itself."""
    docs = documents(spark, [(i, prose(i, 80)) for i in range(40)])
    scores = []
    for good in (range(0, 20), range(1, 21)):
        labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
        got = lm_scoring.cross_entropy_difference(docs, labels, F.col("quality") == 1)
        scores.append({r["doc_id"]: r["score"] for r in got.collect()})
    assert abs(scores[0][0] - scores[1][0]) < 0.5 and abs(scores[0][0]) < 0.5 and abs(scores[1][0]) < 0.5


def test_scores_do_not_follow_the_sizes_of_the_parts(spark):
    """A hundred texts of a kind of which few are the target: neither model is favoured for its size."""
    docs = documents(spark, [(i, prose(i, 80)) for i in range(100)])
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    got = [r["score"] for r in lm_scoring.cross_entropy_difference(docs, labels, F.col("quality") == 1).collect()]
    assert abs(sum(got) / len(got)) < 0.3
