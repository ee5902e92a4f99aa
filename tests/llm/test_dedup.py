"""Line dedup, components and near-duplicates against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from curbsight.llm import components, line_dedup, near_dedup
from tests.llm.conftest import ODD, documents, prose


def cut_by_rule(rows: list[tuple], shortest: int) -> dict:
    """Words that stand in a run of ``shortest`` words which occurred before, by ascending id and place."""
    seen: set = set()
    out = {}
    for doc_id, text in sorted(rows):
        words = text.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - shortest + 1):
            run = tuple(words[i:i + shortest])
            if run in seen:
                gone[i:i + shortest] = [True] * shortest
            seen.add(run)
        out[doc_id] = [w for w, g in zip(words, gone) if not g]
    return out


def shared_passages() -> list[tuple]:
    draw = random.Random(11)
    passages = [prose(1000 + i, draw.randint(50, 90)) for i in range(5)]
    rows = []
    for i in range(80):
        text = prose(i, draw.randint(0, 200)).split(" ")
        for _ in range(draw.randint(0, 2)):
            at = draw.randint(0, len(text))
            text[at:at] = [draw.choice(passages)]
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[i][1]) for i in range(10)]  # exact copies
    for i in range(10):  # near copies
        words = rows[20 + i][1].split(" ")
        for _ in range(3):
            words[draw.randrange(len(words))] = "changed"
        rows.append((300 + i, " ".join(words)))
    rows += [(402, prose(77, 3000))]
    return rows


def test_stretches_that_repeat_themselves(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PAGES_AT_ONCE", 2)
    pair = prose(5, 20) + " "
    rows = [(1, "word " * 300), (2, "word " * 90), (3, pair * 30), (4, "x y " + pair * 30), (5, pair * 10)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: "word ", 2: "", 3: pair, 4: "x y ", 5: ""}
    frames = line_dedup.repeated_spans(
        np.arange(1, 200, dtype=np.uint32), np.zeros(4, np.int64), np.array([0, 0, 10, 10]), np.array([0, 1, 1, 2]),
        np.stack([np.arange(1, 65), np.arange(65, 129), np.arange(75, 139), np.arange(139, 203)]).astype(np.uint32))
    assert frames == [(0, 199)]


def test_repeated_runs_are_cut_and_nothing_else(spark):
    rows = shared_passages()
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, rows, extra=True)).collect()}
    expected = cut_by_rule(rows, line_dedup.RUN_WORDS)
    assert set(got) == set(expected)
    removed = left_over = 0
    for i, text in rows:
        kept, words = got[i]["text"].encode().split(), text.encode().split()
        assert got[i]["n_removed"] == len(words) - len(kept)
        assert got[i]["key"] == 1 and got[i]["pos"] == 0.5 and got[i]["n_words"] == "w"
        rest = iter(kept)
        assert all(w in rest for w in expected[i])  # nothing else is cut
        if not got[i]["n_removed"]:
            assert got[i]["text"] == text
        removed += got[i]["n_removed"]
        left_over += len(kept) - len(expected[i])
    # A run is compared with the first text that holds its fingerprint; another one may agree in a word more.
    assert removed > 2000 and left_over <= removed / 500


def test_line_dedup_of_odd_rows(spark):
    long = prose(1, 70)
    rows = [*ODD, (8, long), (8, long), (9, "x " + long), (None, long)]
    got = line_dedup.dedup_lines(documents(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [*ODD, (8, ""), (8, ""), (9, "x"), (None, long)], key=repr)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def exactly_by_rule(spark, rows) -> None:
    expected = cut_by_rule(rows, line_dedup.RUN_WORDS)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        assert got[i]["text"].encode().split() == expected[i], i
        assert got[i]["n_removed"] == len(text.encode().split()) - len(expected[i])


def test_copies_of_a_passage_that_an_earlier_text_holds_in_part(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK_RUNS", 300)
    monkeypatch.setattr(line_dedup, "BUCKET_RUNS", 200)
    rows = shared_passages()
    for i in range(60):  # the first holds the middle, the others all of it
        passage = [f"p{i}x{j}" for j in range(51 + i)]
        middle = min(49, 20 + i)
        at = (len(passage) - middle) // 2
        rows += [(1000 + 10 * i + k, " ".join([prose(5000 + 10 * i + k, 30), *words, prose(9000 + 10 * i + k, 30)]))
                 for k, words in enumerate([passage[at:at + middle], passage, passage, passage])]
    exactly_by_rule(spark, rows)


def test_equal_lines_between_words_that_vary(spark):
    rows = []
    for i in range(40):
        x = [f"x{i}y{j}" for j in range(16 + i % 12)]
        y = [[f"v{i}y{k}z{j}" for j in range(1 + i % 7)] for k in range(3)]
        rows += [(10 * i, " ".join([*x, *y[0], *x, *y[1], *x, *y[2], *x])),
                 (10 * i + 1, " ".join([prose(i, 20), *x, *y[0], *x, *y[1], *x[:9]]))]
    rows.append((900, "a b c " * 40 + "d " + "a b c " * 30))
    rows.append((901, "x " + "a b c " * 20 + "d " + "a b c " * 35))
    exactly_by_rule(spark, rows)


def test_cut_joins_what_is_left():
    assert line_dedup.cut(b"a b c\nd e f", [(1, 2)]) == b"a c\nd e f"
    assert line_dedup.cut(b"a b\nc\nd", [(2, 3)]) == b"a b\nd"
    assert line_dedup.cut(b"a b c", [(0, 3)]) == b""
    assert line_dedup.cut(b"a b c\n", [(0, 1), (2, 3)]) == b"b\n"


def test_winnowing_is_bound_to_choose_in_every_window():
    lines = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    chosen, *_ = line_dedup.winnow(lines)
    for i in range(len(lines) - line_dedup.WINDOW + 1):
        window = lines[i:i + line_dedup.WINDOW]
        last = i + np.flatnonzero(window == window.min())[-1]
        later = chosen[(lines[chosen] == lines[last]) & (chosen >= last)]
        assert len(later)
    assert [x.tolist() for x in line_dedup.winnow(np.full(100, 7, np.uint64))] == [[99], [99], [1]]
    assert [x.tolist() for x in line_dedup.winnow(np.tile(np.arange(9, dtype=np.uint64), 40))] == [[351], [351], [9]]
    many, back, period = line_dedup.winnow(np.random.default_rng(1).integers(0, 1 << 60, 10_000).astype(np.uint64))
    assert len(many) < 700 and not back.any() and not period.any()


# --- components ------------------------------------------------------------------------------


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(5, 3), (3, 5), (7, 7), (9, 8), (8, 3)], [],
    [(random.Random(4).randint(0, 5) * 0 + i, (i * 7 + 3) % 90) for i in range(90)]],
    ids=["chain", "star", "small", "empty", "cycles"])
def test_components(spark, links):
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in
           components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}


# --- near-duplicates -------------------------------------------------------------------------


def similar_by_rule(a: str, b: str) -> float:
    def counts(text):
        words = text.encode().translate(near_dedup._WORD_BYTES).split()
        size = min(5, len(words))
        out: dict = {}
        for i in range(len(words) - size + 1 if words else 0):
            run = tuple(words[i:i + size])
            out[run] = out.get(run, 0) + 1
        return out

    x, y = counts(a), counts(b)
    every = {*x, *y}
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x if i in y)


def test_probability_jaccard_is_exact():
    for i in range(20):
        a = prose(i, 60) + " the the the the the the the"
        b = " ".join(a.split(" ")[i:]) + " " + prose(i + 50, 3 * i)
        assert near_dedup.probability_jaccard(near_dedup.shingles(a), near_dedup.shingles(b)) == \
            pytest.approx(similar_by_rule(a, b))


def test_slots_agree_as_often_as_the_similarity_says():
    a = prose(1, 600) + " so so so so so so so so so so so so"
    b = " ".join(a.split(" ")[120:]) + " " + prose(2, 80)
    sets = [near_dedup.shingles(a), near_dedup.shingles(b), near_dedup.shingles("only"), near_dedup.shingles(a)]
    found = near_dedup.signatures(sets)
    assert (found[0] == found[3]).all() and len(set(found[2].tolist())) == 1
    true = similar_by_rule(a, b)
    assert abs((found[0] == found[1]).mean() - true) < 4 * (true * (1 - true) / near_dedup.SLOTS) ** 0.5
    alone = near_dedup.signatures([sets[1]])
    assert (alone[0] == found[1]).all()


def near_copies() -> list[tuple]:
    draw = random.Random(2)
    rows = [(i, prose(i, draw.randint(3, 150))) for i in range(60)]
    for group in range(4):  # copies of one text with some words changed, pairs of them above and below the threshold
        base = prose(900 + group, 100).split(" ")
        for i in range(25):
            words = list(base)
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = f"other{draw.randint(0, 5)}"
            rows.append((1000 + 100 * group + i, " ".join(words)))
    passage = prose(55, 60)  # shared by texts that are otherwise different
    rows += [(2000 + i, passage + " " + prose(300 + i, 60)) for i in range(30)]
    rows += [(3000 + i, rows[i][1]) for i in range(8)] + [(3100, ""), (3101, " . "), (3102, None), (3103, "")]
    return rows


def classes_by_rule(rows):
    texts = [t or "" for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j] or similar_by_rule(texts[i], texts[j]) >= near_dedup.THRESHOLD:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    groups: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return {doc_id: min(ids) for ids in groups.values() for doc_id in ids}


@pytest.mark.parametrize("block", [512, 4], ids=["one-block", "blocks"])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block)
    rows = near_copies()
    got = near_dedup.near_duplicates(documents(spark, rows, extra=True)).collect()
    expected = classes_by_rule(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == expected
    assert {r["doc_id"] for r in got if r["kept"]} == set(expected.values())
    assert all(r["node"] == "n" for r in got)


def test_one_of_each_class_stays_unchanged(spark):
    rows = [*ODD, (20, "A b c d e f"), (21, "a b c d e f"), (22, "a b c d e g")]
    got = near_dedup.without_near_duplicates(documents(spark, rows)).collect()
    # "one two" without an id, and two equal rows of id 4: one row stays; nulls come first.
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(
        [(1, ""), (3, "   \n "), (None, "one two"), (5, "a"), ODD[-1], (20, "A b c d e f"),
         (22, "a b c d e g")], key=repr)
    assert near_dedup.without_near_duplicates(documents(spark, [])).count() == 0


def test_shingle_hashes_keep_counts():
    found, counts = near_dedup.shingles("a a a a a a a")
    assert len(found) == 1 and counts.tolist() == [3.0]
    assert len(near_dedup.shingles(" .,! ")[0]) == 0 and zlib.crc32(b"a") != 0
