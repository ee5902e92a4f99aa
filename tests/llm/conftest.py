from __future__ import annotations

import random

import pytest

from curbsight.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


SYLLABLES = ["an", "the", "er", "in", "on", "re", "é", "ti", "ß", "or", "nd", "st"]


def prose(seed: int, words: int) -> str:
    """Invented words in sentences and lines."""
    draw = random.Random(seed)
    out = []
    for _ in range(words):
        word = "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4)))
        end = draw.random()
        out.append(word + ("." if end < 0.08 else "," if end < 0.12 else "") + ("\n" if end > 0.97 else " "))
    return "".join(out).strip()


def documents(spark, rows: list[tuple], extra: bool = False):
    """doc_id, text and, on request, columns whose names the operators use themselves."""
    shape = "doc_id long, text string"
    if extra:
        shape += ", key long, row string, n_words string, score string, part int, node string, pos double"
        rows = [(*r, 1, "r", "w", "s", 2, "n", 0.5) for r in rows]
    return spark.createDataFrame(rows, shape)


#: Nulls, empty and blank texts, ties, repeated rows.
ODD = [(1, ""), (2, None), (3, "   \n "), (None, "one two"), (4, "one two"), (4, "one two"), (5, "a"), (6, "Σ é İ")]
