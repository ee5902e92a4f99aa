"""Spelling variants against plain restatements: all pairs compared, and the query word by word."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from curbsight.llm import spelling
from curbsight.llm.registry import QUERIES
from tests.llm.conftest import ODD, documents


def edits(word: str, alphabet: str) -> set:
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    return out - {word}


def plain(counts: dict, times: int = 10) -> dict:
    """Every edit of every word looked up."""
    alphabet = "".join(sorted(set("".join(counts))))
    near = {w: {e for e in edits(w, alphabet) if e in counts} for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= times * counts[word] else None

    def root(word: str) -> str:
        while form[word] is not None:
            word = form[word]
        return word

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def found(frame) -> dict:
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def vocabulary(spark, counts: dict):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def crowded(seed: int, n: int, letters: str = "abé") -> dict:
    """Words of few letters, so that most have many near ones; some begin or end alike at length."""
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, 6))) for _ in range(n)}
    words |= {"abcdefgh" * 3 + w for w in list(words)[: n // 3]} | {w + "hgfedcba" for w in list(words)[: n // 3]}
    return {w: draw.choice([1, 2, 10, 10, 100, 1000]) for w in words}


@pytest.mark.parametrize("partition_words", [1, 5, 4096])
def test_all_near_pairs_whatever_the_size_of_a_partition(spark, partition_words):
    counts = crowded(3, 150)
    assert found(spelling.spelling_variants(vocabulary(spark, counts), 10, partition_words)) == plain(counts)


def test_pairs_come_once(spark):
    counts = {**crowded(4, 120, "ab"), "aaaaaaaa": 1, "aaaaaaaaa": 1, "baaaaaaa": 1}
    pairs = spelling.near_pairs(vocabulary(spark, counts), 7).collect()
    names = [frozenset((r["word"], r["near"])) for r in pairs]
    assert len(names) == len(set(names)) == sum(v[3] for v in plain(counts).values()) // 2
    assert all((r["n"], r["near_n"]) == (counts[r["word"]], counts[r["near"]]) for r in pairs)


def test_equal_states_exist_once():
    """Words that differ in the first letters only share everything behind them."""
    machine = spelling.Acceptor()
    start = machine.add(sorted(a + b + "tail" for a in "abc" for b in "xyz"))
    assert len(machine.arcs) == 7 and len(machine.arcs[start]) == 3
    assert len(set(machine.arcs[start].values())) == 1


def test_chains_of_forms_and_ties(spark):
    counts = {"colour": 1, "colours": 10, "coloursx": 100, "coloursxy": 1000, "b": 5, "c": 50, "d": 50, "lonely": 7}
    rows = found(spelling.spelling_variants(vocabulary(spark, counts)))
    assert rows["colour"][:2] == ("colours", "coloursxy") and rows["b"][:2] == ("c", "c")
    assert rows["lonely"] == (None, "lonely", 7, 0, None) and rows == plain(counts)


def plain_words(rows, least_chars: int, least_count: int, every: int) -> dict:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}


def test_words_of_odd_documents(spark):
    rows = [*ODD, (7, "ÀBCDEFGH abcdefg×h ABCDEFGHI_abcdefghi-Σabcdefgh"), (7, "ab " * 300_000 + "z" * 100_000),
            (8, "Abcdefghi " * 400), (9, "z" * 100_000 + " " + "z" * 50_000 + "y" + "z" * 50_000)]
    for least_chars, least_count, every in ((1, 1, 2), (7, 2, 3), (3, 1, 10**9)):
        words = spelling.count_words(documents(spark, rows, extra=True), least_chars, least_count, every)
        assert {r["word"]: r["n"] for r in words.collect()} == plain_words(rows, least_chars, least_count, every)
    long = found(spelling.spelling_variants(spelling.count_words(documents(spark, rows), 7, 1)))
    assert long["z" * 100_000][3] == 1


def test_empty_and_null_vocabularies(spark):
    assert spelling.spelling_variants(spelling.count_words(documents(spark, []))).count() == 0
    rows = spark.createDataFrame([(None, 3), ("abc", None), ("abd", 2), ("abd", 3), ("abcd", 60)], "word string, n long")
    assert found(spelling.spelling_variants(rows)) == {
        "abd": ("abcd", "abcd", 5, 1, 60), "abcd": (None, "abcd", 60, 1, None)}
    with pytest.raises(ValueError):
        spelling.spelling_variants(rows, times=1)


def test_query_against_all_edits_of_all_words(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    assert found(QUERIES["op13_spelling_variants"](spark, sf)) == plain(plain_words(rows, 7, 2, 31))


def test_no_hot_group_stays_whole(spark):
    """A third of all words with the same half: no partition above the bound, except at a single position."""
    counts = {f"abcdefgh{i:06d}".translate(str.maketrans("0123456789", "ghijklmnop")): 1 for i in range(3000)}
    pairs = spelling.near_pairs(vocabulary(spark, counts), 100)
    assert pairs.count() == sum(v[3] for v in plain(counts).values()) // 2
    assert pairs.select(F.count_distinct("word")).first()[0] > 2000
