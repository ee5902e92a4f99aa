"""Token files and packing against the library itself."""

from __future__ import annotations

import sys
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbsight.llm import packing, token_files
from curbsight.llm.registry import word_bpe
from curbsight.llm.tokens import TextEncoder, encoder
from tests.llm.conftest import ODD, documents, prose

LIBRARY = Tokenizer.from_file(word_bpe())


def ids_of(text: str | None) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = st.text(alphabet=st.sampled_from(list(
    "abzAZ09 .,'!<|>\n\t\r\x0b\x0c\x1c\x85\xa0éÉßΣσςİı́ 　中ff²½€𝒜")), max_size=30)


@settings(max_examples=400, deadline=None)
@given(ODD_TEXTS)
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(encoder(word_bpe()).encode(text), "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", [
    "it's we'll I'M don't'", "<|endoftext|> x", "<|ENDOFTEXT|>", "a<|startoftext|>b", "ΑΣ ΑΣ. σας", "é ́e",
    "3.14% ***word***", "naïve. Ünïcödé,", prose(3, 400)])
def test_ids_of_hard_texts(text):
    assert np.frombuffer(TextEncoder(word_bpe()).encode(text), "<u4").tolist() == ids_of(text)


def test_ids_of_letters_with_marks_of_their_own():
    """All letters whose lower form is more than one character, or ends in a mark, before all ASCII marks."""
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()
               and (len(c.lower()) > 1 or unicodedata.category(c.lower()[-1]).startswith("M"))]
    assert "İ" in letters
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    own = encoder(word_bpe())
    for text in (f"{a}{c}{mark}{b}" for c in letters for mark in marks for a, b in (("", ""), ("gaz", ""), ("", "x"), ("GA", "Zİ.,"))):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids_of(text), text
    assert own.encode("BELEDİYESİ, GAZİ.") == np.array(ids_of("BELEDİYESİ, GAZİ."), "<u4").tobytes()


def test_ids_of_every_letter_before_a_mark():
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    own = encoder(word_bpe())
    texts = [f"a{c}, {c}." for c in letters]
    for text, ids in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids.ids, text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=60), st.integers(6, 16))
def test_code_lengths_form_a_complete_code_and_are_limited(counts, limit):
    lengths = token_files.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit
    if len(counts) > 1:
        assert sum(2.0 ** -int(x) for x in lengths) == 1.0


def test_code_lengths_are_as_good_as_unlimited_huffman():
    import heapq

    counts = np.array([50, 30, 10, 5, 3, 2])
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert int((token_files.code_lengths(counts) * counts).sum()) == cost


def test_codes_round_trip_at_every_checkpoint():
    draw = np.random.default_rng(1)
    counts = (1e6 / np.arange(1, 3001) ** 1.3).astype(int) + 1
    used = np.sort(draw.choice(40_000, 3000, replace=False))
    book = token_files.CodeBook(used, token_files.code_lengths(counts))
    for n in (1, 2, 255, 256, 257, 5000):
        ids = draw.choice(used, n, p=counts / counts.sum())
        payload, marks = book.encode(ids)
        assert token_files.decode_block(book, [n], payload, marks.astype("<u8").tobytes())[0] == \
            ids.astype("<u4").tobytes()


def expected(rows, end):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(
        np.array([*ids_of(r[1]), end], "<u4").tobytes())))
    at, out = 0, []
    for doc_id, text in ordered:
        ids = np.array([*ids_of(text), end], "<u4")
        out.append((doc_id, at, len(ids), ids.tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("rows", [
    ODD, [], [(7, None)], [(i * 3, prose(i, i % 90)) for i in range(400)] + [(9, prose(1, 60_000))]],
    ids=["odd", "empty", "one", "many"])
def test_files_give_back_all_ids_in_order(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 4000)
    path = str(tmp_path / "files")
    token_files.write_tokens(documents(spark, rows, extra=True), path, word_bpe(), end_id=1)
    got = [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"]))
           for r in token_files.read_tokens(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows, 1)


def packed_by_rule(lengths: list[int], capacity: int) -> int:
    """Best-two-fit run piece by piece, as a number of sequences."""
    left, sequences = sorted(lengths, reverse=True), 0
    while left:
        gap, taken = capacity, []
        for x in list(left):
            if x <= gap:
                taken.append(x)
                left.remove(x)
                gap -= x
        if gap:
            smallest = taken[-1]
            room = smallest + gap
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:] if a + b <= room]
            if pairs and max(pairs)[0] > smallest:
                _, a, b = max(pairs)
                taken[-1:] = [a, b]
                left.remove(a)
                left.remove(b)
                left.append(smallest)
                left.sort(reverse=True)
        sequences += 1
    return sequences


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_on_counts_is_the_rule(lengths):
    patterns = packing.plan_patterns({x: lengths.count(x) for x in set(lengths)}, 40)
    assert sorted(x for p in patterns for x in p.lengths * p.times) == sorted(lengths)
    assert all(sum(p.lengths) <= 40 for p in patterns)
    assert sum(p.times for p in patterns) == packed_by_rule(lengths, 40)


def check_packed(rows, pieces, capacity, end):
    texts = sorted(((r[0] is not None, r[0] or 0, tuple([*ids_of(r[1]), end])) for r in rows))
    by_row: dict = {}
    for p in pieces:
        by_row.setdefault(p["row"], []).append(p)
    found = []
    for own in by_row.values():
        own.sort(key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own)))
        assert [p["start"] for p in own] == [capacity * i for i in range(len(own))]
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in own), "<u4")
        assert all(p["length"] == capacity for p in own[:-1])
        assert [p["ids_crc32"] for p in own] == [zlib.crc32(bytes(p["ids"])) for p in own]
        found.append((own[0]["doc_id"] is not None, own[0]["doc_id"] or 0, tuple(ids.tolist())))
    assert sorted(found) == texts
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("rows", [
    ODD, [], [(i, prose(i, i % 70)) for i in range(300)] + [(1000 + i, "a b c") for i in range(200)]],
    ids=["odd", "empty", "many"])
def test_all_pieces_are_packed_without_gaps(spark, rows, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 40)
    packed = packing.pack_documents(documents(spark, rows, extra=True), word_bpe(), end_id=0, capacity=64)
    pieces = packed.collect()
    n = check_packed(rows, pieces, 64, 0)
    total = sum(p["length"] for p in pieces)
    assert n <= -(-total // 64) + max(1, total // 64 // 50)
    whole = packing.sequences(packed).collect()
    assert sorted(x for r in whole for x in np.frombuffer(bytes(r["ids"]), "<u4").tolist()) == \
        sorted(x for r in rows for x in [*ids_of(r[1]), 0])
