"""Best-two-fit packing of token sequences.

Documents are tokenized, and only those longer than a sequence are cut. A sequence is filled greedily: always the
longest piece that still fits. Then its smallest piece is exchanged for the two unpacked pieces that together fill
the widened gap best, if that leaves less of it.

What a sequence looks like depends only on how many pieces of each length are left. So the plan is made on the
counts per length (at most ``capacity`` numbers, whatever the size of the corpus): a pattern that can be filled m
times is applied m times, which gives what m single runs of the rule would. Pieces are then numbered within
their length, in parallel, and each number looks its place up in the plan.

Nulls and empty texts are one piece with only the end id. Repeated rows are packed once per row; a null ``doc_id``
is kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, RowNames, stored, values
from curbsight.llm.tokens import encoder

PIECES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
PIECES_SQL = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, ids binary"
#: Pieces of one length are numbered in groups of about this many.
GROUP_ROWS = 20_000


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = True) -> DataFrame:
    """The pieces of each document: its ids and the end id, cut only where it is longer than a sequence."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names, out = encoder(tokenizer).encode, RowNames(), Emitter(PIECES)
        for batch in batches:
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                ids, row = encode(text) + end, names.take()
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.add((doc_id, row, piece, at // 4, len(part) // 4, zlib.crc32(part),
                             part if with_ids else None), len(part) if with_ids else 0)
                yield from out.ready()
        yield from out.rest()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES_SQL)


@dataclass
class Pattern:
    """``times`` sequences with the same lengths, numbered from ``first``."""

    lengths: list[int]
    times: int
    first: int


def plan_patterns(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-two-fit on counts per length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out, first = [], 0
    longest = np.zeros(capacity + 1, np.int64)  # the longest length left that is not above the index; 0: none

    def refresh() -> None:
        np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0), out=longest)

    refresh()
    while longest[capacity]:
        taken: list[int] = []
        gap = capacity
        while gap and longest[gap]:
            length = int(longest[gap])
            fits = min(int(left[length]), gap // length)
            taken += [length] * fits
            gap -= length * fits
            left[length] -= fits
            if not left[length]:
                refresh()
        smallest = taken[-1]
        if gap and len(taken) > 1 or gap and smallest > 1:
            a, b = _best_two(left, longest, smallest + gap)
            if a + b > smallest:
                taken[-1:] = [a, b]
                left[smallest] += 1
                left[a] -= 1
                left[b] -= 1
        used = {x: taken.count(x) for x in taken}
        more = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * more
        refresh()
        out.append(Pattern(taken, 1 + more, first))
        first += 1 + more
    return out


def _best_two(left: np.ndarray, longest: np.ndarray, room: int) -> tuple[int, int]:
    """The two unpacked lengths with the largest sum that fits ``room``; 0, 0 if there are none."""
    a = np.flatnonzero(left[:room])
    if not len(a):
        return 0, 0
    b = longest[np.minimum(room - a, a)]  # the second is not longer than the first
    alone = (b == a) & (left[a] < 2)
    b = np.where(alone, longest[a - 1], b)
    total = np.where(b > 0, a + b, 0)
    best = int(np.argmax(total))
    return (int(a[best]), int(b[best])) if total[best] else (0, 0)


def _places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: where each run of numbers begins, its first sequence, its pieces per sequence, their offsets."""
    runs: dict[int, list] = {}
    numbered: dict[int, int] = {}
    for pattern in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in pattern.lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, where in offsets.items():
            begin = numbered.get(length, 0)
            runs.setdefault(length, []).append((begin, pattern.first, len(where), where))
            numbered[length] = begin + pattern.times * len(where)
    out = {}
    for length, rows in runs.items():
        width = np.array([r[2] for r in rows], np.int64)
        at = np.concatenate([[0], np.cumsum(width)])[:-1]
        out[length] = (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), width, at,
                       np.array([o for r in rows for o in r[3]], np.int64))
    return out


def numbered_within(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``number``: 0, 1, ... within each length, counted in groups so that no length is one task's work."""
    groups = max(1, rows // GROUP_ROWS)
    grouped = pieces.withColumn("salt", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int"))
    before = grouped.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "length", "salt", "sum(n) over (partition by length order by salt) - n as before")
    ranked = grouped.selectExpr(
        "*", "row_number() over (partition by length, salt order by row, piece) - 1 as in_group")
    return ranked.join(before, ["length", "salt"]).withColumn("number", F.col("before") + F.col("in_group")) \
        .drop("salt", "in_group", "before")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``row``, ``piece`` and ``length`` (1 to capacity).

    ``pieces`` has to be a stored table, as it is read twice.
    """
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan_patterns(counts, capacity)))
    numbered = numbered_within(pieces, sum(counts.values()))
    names = [f.name for f in pieces.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("number")).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                begin, first, width, at, offsets = places.value[int(length[rows[0]])]
                run_no = np.searchsorted(begin, number[rows], "right") - 1
                within = number[rows] - begin[run_no]
                sequence[rows] = first[run_no] + within // width[run_no]
                offset[rows] = offsets[at[run_no] + within % width[run_no]]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = True) -> DataFrame:
    """Every piece with its sequence and its place there; ``ids`` are null unless asked for."""
    return pack(stored(cut_pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, doc_ids and ids in order of offset."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("inside")).selectExpr(
        "sequence_id", "transform(inside, x -> x.doc_id) as doc_ids",
        "aggregate(inside, binary(''), (all, x) -> concat(all, x.ids)) as ids")
