"""The index against searching, and the job against a plain scan."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from curbsight.llm import decontamination as dec
from tests.llm.conftest import ODD, documents, prose


def test_index_finds_what_a_search_finds():
    draw = np.random.default_rng(0)
    for trial in range(20):
        docs = [draw.integers(1, 8, draw.integers(0, 40)) for _ in range(draw.integers(1, 12))]
        docs *= 1 + 2 * (trial % 3 == 0)  # copies: long ties between suffixes
        symbols = np.concatenate([np.append(d, dec.SEPARATOR) for d in docs])
        ends = np.cumsum(symbols == dec.SEPARATOR)
        keys = [int(ends[i]) if symbols[i] == dec.SEPARATOR else 1000 + int(symbols[i]) for i in range(len(symbols))]
        assert dec.suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: keys[i:])
        index = dec.FmIndex(symbols, 8)
        for length in (1, 2, 3, 5):
            phrases = np.unique(draw.integers(1, 8, (50, length)), axis=0)
            which, low, high = index.search(phrases)
            found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
            for i, phrase in enumerate(phrases):
                places = [j for j in range(len(symbols) - length + 1) if (symbols[j:j + length] == phrase).all()]
                assert found.get(i, []) == places


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def found_by_rule(rows, items, window=13):
    phrases: dict = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w and item_id is not None else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(item_id)
    sizes = {len(p) for p in phrases}
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in phrases:
                    hit.update(range(i, i + size))
                    found |= phrases[tuple(w[i:i + size])]
        yield doc_id, len(w), len(hit), sorted(found), sorted(hit)


def fixture():
    draw = random.Random(6)
    items = [(i, prose(500 + i, draw.randint(1, 40))) for i in range(25)]
    items += [(3, "Only two"), (30, None), (31, ""), (None, "some words here"), (32, "! ."), (33, items[4][1])]
    rows = list(ODD)
    for i in range(60):
        text = prose(i, draw.randint(0, 120)).split(" ")
        for _ in range(draw.randint(0, 3)):
            w = (draw.choice(items)[1] or "").split(" ")
            part = w[draw.randint(0, 4):][:draw.randint(1, 40)]
            at = draw.randint(0, len(text))
            text[at:at] = [" ".join(part).upper() if draw.random() < 0.3 else " ".join(part)]
        rows.append((100 + i, " ".join(text)))
    rows += [(300, "x only two y ONLY-TWO"), (301, " ".join([items[2][1]] * 40))]
    return rows, items


@pytest.mark.parametrize("shard, block", [(1 << 20, 2_000_000), (60, 2_000_000), (1 << 20, 100)],
                         ids=["one", "shards", "blocks"])
def test_hits_are_those_of_a_plain_scan(spark, monkeypatch, shard, block):
    # The functions run in workers; the size of a shard travels with them as a module value only here.
    rows, items = fixture()
    docs = documents(spark, rows, extra=True)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    if shard == 60:
        phrases = dec.Phrases([(i, dec.words_of(t)) for i, t in items if i is not None and t is not None], 13)
        monkeypatch.setattr(dec, "SHARD_SYMBOLS", shard)
        own = [dec.Document(dec.words_of(t), phrases) for _, t in rows]
        dec.search_documents(own, phrases)
        got = [(i, d.n_words, sum(e - s for s, e in d.spans()), sorted(d.items),
                [x for s, e in d.spans() for x in range(s, e)]) for (i, _), d in zip(rows, own)]
    else:
        found = dec.find_benchmark(docs, benchmark, ["doc_id", "row", "part"], cut_text=True, block_words=block)
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"],
                [x for s in r["spans"] for x in range(s["start"], s["end"])]) for r in found.collect()]
        for r in found.collect():
            if r["kept_text"] is not None:
                assert len(words(r["kept_text"])) == r["n_words"] - r["n_hit"] and r["row"] == "r"
    assert sorted(got, key=repr) == sorted(found_by_rule(rows, items), key=repr)


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = dec.contaminated(dec.find_benchmark(documents(spark, ODD), none, ["doc_id"])).collect()
    assert len(got) == len(ODD) and not any(r["contaminated"] or r["n_hit"] for r in got)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dec.find_benchmark(documents(spark, []), items, ["doc_id"]).count() == 0


def test_share_of_words_decides(spark):
    item = " ".join(f"w{i}" for i in range(13))
    rows = [(1, item + " z" * 247), (2, item + " z" * 248), (3, "z")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = dec.contaminated(dec.find_benchmark(documents(spark, rows), items, ["doc_id"])).collect()
    assert {r["doc_id"]: r["contaminated"] for r in got} == {1: True, 2: False, 3: False}
