"""Alignment of two tokenizers against a plain restatement with the libraries themselves, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbsight.llm import alignment
from curbsight.llm.registry import QUERIES
from curbsight.llm.tokens import byte_letters
from tests.llm.conftest import ODD, documents, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY_A = Tokenizer.from_file(A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = {c: b for b, c in byte_letters().items()}


def spans(ids: list, piece) -> list:
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(piece(i))))
        at += len(piece(i))
    return out


def piece_a(i: int) -> bytes:
    return bytes(LETTERS[c] for c in LIBRARY_A.id_to_token(i))


def piece_b(i: int) -> bytes:
    piece = LIBRARY_B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if LIBRARY_B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(rows: list) -> list:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    aligned, counts = [], Counter()
    for doc_id, text in rows:
        a = LIBRARY_A.encode(" " + text, add_special_tokens=False).ids if text else []
        b = LIBRARY_B.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(map(piece_a, a)) != whole or b"".join(map(piece_b, b)) != whole:
            a = b = []
        spans_a, spans_b = spans(a, piece_a), spans(b, piece_b)
        links, first = [], 0
        for i, low, high in spans_a:
            while first < len(spans_b) and spans_b[first][2] <= low:
                first += 1
            k = first
            while k < len(spans_b) and spans_b[k][1] < high:
                links.append((i, spans_b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in spans_a} & {e for *_, e in spans_b})
        groups = [(",".join(str(i) for i, _, e in spans_a if low < e <= high) + "|"
                   + ",".join(str(i) for i, _, e in spans_b if low < e <= high))
                  for low, high in zip([0, *cuts], cuts)] if len(whole) < 5000 else None
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), len(cuts), links, groups))
    most: Counter = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[1]] for p in links),
                    sum(counts[p] for p in links),
                    None if groups is None else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                   for doc_id, n_a, n_b, n_groups, links, groups in aligned), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(frame) -> list:
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=repr)


STRANGE = ["<|endoftext|>", "a<|endoftext|>b <s></s><unk><0x41>", "▁x ▁", "  two  blanks \n\n\t x", "日本語 тест",
           "🙂🙂 é́", "İSTANBUL ﬁ ½ x y", "\x00\x01", "'ll I'LL we're", "12345 1,000.5", "x" * 300, " "]


def test_strange_texts(spark):
    rows = [*ODD, *((10 + i, t) for i, t in enumerate(STRANGE)), *((50 + i, prose(i, 60)) for i in range(10)),
            (90, prose(1, 60)), (91, prose(1, 60))]
    expected = plain(rows)
    assert found(alignment.align(spark, documents(spark, rows, extra=True), A, B)) == expected
    assert found(alignment.align(spark, documents(spark, rows).repartition(5), A, B, chunk_links=50)) == expected


def test_query_against_the_libraries(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    ours, theirs = found(QUERIES["op12_token_alignment"](spark, sf)), plain(rows)
    assert [r[:7] for r in ours] == [r[:7] for r in theirs]
    assert all(x[7] == y[7] for x, y in zip(ours, theirs) if y[7] is not None)


def test_very_long_and_empty(spark):
    long = " ".join(prose(i, 50) for i in range(800)) + "é" * 20_000
    rows = [(1, long), (2, prose(3, 30))]
    ours, theirs = found(alignment.align(spark, documents(spark, rows), A, B)), plain(rows)
    assert [r[:7] for r in ours] == [r[:7] for r in theirs] and ours[1] == theirs[1]
    assert alignment.align(spark, documents(spark, []), A, B).count() == 0
    assert found(alignment.align(spark, documents(spark, [(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_identity_has_the_same_bytes():
    pair = alignment.pair_of(A, B)
    assert [pair.a.bytes[i] for i in range(1000, 1100)] == [piece_a(i) for i in range(1000, 1100)]
    assert all(pair.b.bytes[b] == pair.a.bytes[a] for a, b in enumerate(pair.same) if b >= 0)
    assert (pair.same >= 0).sum() > 10_000


def test_identical_groups_stay_out_of_the_pairs(spark):
    """A chunk's own pairs are those of irregular groups; the rest is in the task's vector."""
    rows = alignment.align_chunks(documents(spark, [(1, prose(1, 200))]).coalesce(1), A, B).collect()
    chunk, vector = rows[0], rows[-1]
    assert vector["chunk"] is None and sum(vector["times"]) > 0 and sum(chunk["times"]) > 0
    same = alignment.pair_of(A, B).same
    assert all(same[p >> 32] == p & 0xFFFFFFFF for p in vector["pairs"])
    n = plain([(1, prose(1, 200))])[0][4]
    assert sum(vector["times"]) + sum(chunk["times"]) == n


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aehinorst ETA'.,0129\n\t-éİß"), st.characters(codec="utf-8")), max_size=60))
def test_ids_are_those_of_the_library(text):
    assert alignment.pair_of(A, B).a.encode(text) == LIBRARY_A.encode(text, add_special_tokens=False).ids


def test_every_entry_of_the_vocabulary_gives_the_same_ids():
    encoder, draw = alignment.pair_of(A, B).a, random.Random(5)
    entries = [t for x in encoder.bytes if x and (t := x.decode(errors="ignore")).encode() == x]
    for joined in (entries, ["".join(draw.sample(entries, 4)) for _ in range(20_000)]):
        expected = LIBRARY_A.encode_batch(joined, add_special_tokens=False)
        assert [encoder.encode(t) for t in joined] == [e.ids for e in expected]


@pytest.mark.parametrize("seed", range(3))
def test_numbers_per_document_come_back(seed):
    import numpy as np

    draw = np.random.default_rng(seed)
    doc, number = draw.integers(0, 20, 500), draw.integers(0, 70_000, 500)
    sizes, numbers, times = alignment._uncounted(alignment._counted(doc, number, 22))
    expected = sorted(Counter(zip(doc.tolist(), number.tolist())).items())
    assert list(zip(zip(np.repeat(np.arange(22), sizes).tolist(), numbers.tolist()), times.tolist())) == expected
