"""Token ids as canonical, length-limited Huffman codes in files of independent blocks.

``write_tokens`` encodes texts, counts ids over the whole corpus, derives one code book and writes a folder:

* ``book``    one row per used id: its code length. Canonical codes follow from the lengths alone.
* ``blocks``  Parquet rows, in ascending order of ``doc_id`` over ranges (``part``) and within them (``block``,
  ``tokens_before``). A block holds whole documents and can be decoded on its own: ``doc_ids``, ``n_tokens`` per
  document, the codes as ``payload`` (each document starts at a byte) and ``checkpoints``: the bit offset of every
  ``STEP``-th token of each document. A very long document makes a block of its own, about as large as the row
  that holds its text.

``read_tokens`` decodes blocks by table: the next 16 bits index the id and the length of its code. All stretches
between checkpoints are decoded side by side.

Nulls and empty texts have just the end id. Rows with the same ``doc_id`` are all kept, ordered by their content;
a null ``doc_id`` comes first. Extra columns are ignored. An empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, RowNames, range_of, splits, stored, values
from curbsight.llm.tokens import encoder

MAX_BITS = 16
STEP = 256
BLOCK_TOKENS = 1 << 16
#: Bytes of codes in a range of documents, on average.
PART_BYTES = 8 << 20

IDS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
CODED = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("ids_crc32", pa.int64()), ("n_tokens", pa.int64()),
                   ("codes", pa.binary()), ("marks", pa.binary())])
BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("tokens_before", pa.int64()),
                    ("block_tokens", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                    ("payload", pa.binary()), ("checkpoints", pa.binary())])
BLOCKS_SQL = ("part int, block int, tokens_before long, block_tokens long, doc_ids array<bigint>, n_tokens array<bigint>, "
              "payload binary, checkpoints binary")


# --- the code book ---------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code in which no code is longer than ``max_bits`` (package-merge)."""
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids have no code of {max_bits} bits")
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    merged, levels = leaves, []
    is_leaf = np.ones(n, bool)
    for _ in range(max_bits - 1):
        levels.append(is_leaf)
        half = len(merged) // 2
        packages = merged[0:2 * half:2] + merged[1:2 * half:2]
        both = np.concatenate([leaves, packages])
        sort = np.argsort(both, kind="stable")
        merged, is_leaf = both[sort], sort < n
    levels.append(is_leaf)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(levels):
        used = int(flags[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class CodeBook:
    """Canonical codes of ids: shorter codes first, ids in ascending order within a length."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        sort = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[sort].astype(np.int64), lengths[sort].astype(np.int64)
        widths = np.left_shift(1, MAX_BITS - self.lengths)
        starts = np.concatenate([[0], np.cumsum(widths)])
        codes = starts[:-1] >> (MAX_BITS - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = codes, self.lengths
        self.symbol = np.zeros(1 << MAX_BITS, np.uint32)
        self.width = np.ones(1 << MAX_BITS, np.int64)
        self.symbol[:starts[-1]] = np.repeat(self.ids, widths)
        self.width[:starts[-1]] = np.repeat(self.lengths, widths)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The codes of one document and the bit offset of every STEP-th token."""
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        at = ends - lengths
        word, bit = at >> 5, at & 31
        both = self.code_of[ids] << (64 - lengths - bit).astype(np.uint64)
        n = int(ends[-1] + 31 >> 5) + 1 if len(ids) else 0
        # Fields don't overlap, so adding them up is the same as combining bits; below 2**32 doubles are exact.
        out = np.bincount(word, (both >> np.uint64(32)).astype(np.float64), n)
        out += np.bincount(word + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
        return out.astype(">u4").tobytes()[: int(ends[-1] + 7 >> 3) if len(ids) else 0], at[::STEP]

    def decode(self, payload: bytes, bits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``counts[i]`` ids from each bit offset, all offsets side by side; one row per offset, padded."""
        raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        order = np.argsort(-counts, kind="stable")
        at, left = bits[order].astype(np.int64), counts[order]
        found = np.zeros((int(left[0]) if len(left) else 0, len(bits)), "<u4")
        live = len(left)
        for step in range(len(found)):
            while live and left[live - 1] <= step:
                live -= 1
            now = at[:live]
            peek = window[now >> 3] >> (8 - (now & 7)).astype(np.uint32) & 0xFFFF
            found[step, :live] = self.symbol[peek]
            now += self.width[peek]
        out = np.empty((len(bits), len(found)), "<u4")
        out[order] = found.T
        return out


# --- writing ---------------------------------------------------------------------------------


def encode_texts(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, a unique row name, crc32 and ids of each text with the end id behind them."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names, out = encoder(tokenizer).encode, RowNames(), Emitter(IDS)
        for batch in batches:
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                ids = encode(text) + end
                out.add((doc_id, names.take(), zlib.crc32(ids), ids), len(ids))
                yield from out.ready()
        yield from out.rest()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, row long, ids_crc32 long, ids binary")


def count_ids(encoded: DataFrame) -> DataFrame:
    """Occurrences of each id over the whole corpus; every task sends one row per id that it has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in values(batch, "ids"):
                seen = np.bincount(np.frombuffer(ids, "<u4"))
                if len(seen) > len(total):
                    total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
                total[:len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())],
                                         ["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _coded(encoded: DataFrame, book: CodeBook) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(book)  # at most one entry per id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, out = shared.value, Emitter(CODED)
        for batch in batches:
            for part, doc_id, row, crc, raw in zip(*(values(batch, c) for c in ("part", *IDS.names))):
                ids = np.frombuffer(raw, "<u4")
                codes, marks = book.encode(ids)
                out.add((part, doc_id, row, crc, len(ids), codes, marks.astype("<u8").tobytes()), len(codes))
                yield from out.ready()
        yield from out.rest()

    return encoded.mapInArrow(
        run, "part int, doc_id long, row long, ids_crc32 long, n_tokens long, codes binary, marks binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of whole ranges, in order, as blocks."""
    part, number, before, out = None, 0, 0, Emitter(BLOCKS, rows=64)
    docs: list[tuple] = []

    def flush() -> None:
        nonlocal number, before
        starts = np.cumsum([0] + [len(codes) for _, _, codes, _ in docs])
        marks = np.concatenate([np.frombuffer(m, "<u8") + np.uint64(8 * s)
                                for (_, _, _, m), s in zip(docs, starts.tolist())])
        payload = b"".join(codes for _, _, codes, _ in docs)
        counts = [n for _, n, _, _ in docs]
        out.add((part, number, before, sum(counts), [d for d, *_ in docs], counts, payload, marks.tobytes()), len(payload))
        number += 1
        before += sum(counts)
        docs.clear()

    tokens = 0
    for batch in batches:
        for of, *doc in zip(*(values(batch, c) for c in ("part", "doc_id", "n_tokens", "codes", "marks"))):
            if docs and (of != part or tokens + doc[1] > BLOCK_TOKENS):
                flush()
                yield from out.ready()
                tokens = 0
            if of != part:
                part, number, before = of, 0, 0
            docs.append(doc)
            tokens += doc[1]
    if docs:
        flush()
    yield from out.rest()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``text`` by ascending ``doc_id`` into a new folder."""
    spark = docs.sparkSession
    encoded = stored(encode_texts(docs, tokenizer, end_id), "token-ids")
    counted = sorted(count_ids(encoded).collect())  # at most one row per id of the vocabulary
    ids = np.array([r["id"] for r in counted], np.int64)
    n = np.array([r["n"] for r in counted], np.int64)
    lengths = code_lengths(n)
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, lengths)], "id long, bits int").coalesce(1) \
        .write.parquet(f"{path}/book")
    size = max(1, -(-int((n * lengths).sum()) // 8))
    cuts = splits(encoded, "doc_id", max(1, encoded.count() * PART_BYTES // size))
    ranged = encoded.withColumn("part", range_of("doc_id", cuts))
    dealt = _coded(ranged, CodeBook(ids, lengths)).repartition("part")
    dealt.sortWithinPartitions("part", "doc_id", "ids_crc32", "row").mapInArrow(_blocks, BLOCKS_SQL) \
        .write.option("compression", "uncompressed").parquet(f"{path}/blocks")


# --- reading ---------------------------------------------------------------------------------


def read_book(spark: SparkSession, path: str) -> CodeBook:
    rows = spark.read.schema("id long, bits int").parquet(f"{path}/book").collect()
    return CodeBook(np.array([r["id"] for r in rows], np.int64), np.array([r["bits"] for r in rows], np.int64))


def decode_block(book: CodeBook, counts: list[int], payload: bytes, checkpoints: bytes) -> list[bytes]:
    """The ids of each document of a block as little-endian unsigned 32-bit integers."""
    n = np.array(counts, np.int64)
    lanes = -(-n // STEP)
    per_lane = np.full(int(lanes.sum()), STEP, np.int64)
    last = np.cumsum(lanes) - 1
    per_lane[last] = n - (lanes - 1) * STEP
    found = book.decode(payload, np.frombuffer(checkpoints, "<u8"), per_lane)
    flat = found[np.arange(found.shape[1]) < per_lane[:, None]].tobytes()
    ends = 4 * np.cumsum(n)
    return [flat[e - 4 * c:e] for e, c in zip(ends.tolist(), counts)]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, read from the files."""
    book = spark.sparkContext.broadcast(read_book(spark, path))
    blocks = spark.read.schema(BLOCKS_SQL).parquet(f"{path}/blocks")
    # One row per range, so one per PART_BYTES of codes.
    totals = blocks.groupBy("part").agg(F.sum("block_tokens").alias("n")).orderBy("part").collect()
    before, first = {}, 0
    for row in totals:
        before[row["part"]] = first
        first += row["n"]
    starts = spark.sparkContext.broadcast(before)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for part, earlier, doc_ids, counts, payload, marks in zip(*(values(batch, c) for c in (
                    "part", "tokens_before", "doc_ids", "n_tokens", "payload", "checkpoints"))):
                at = starts.value[part] + earlier
                for doc_id, n, ids in zip(doc_ids, counts, decode_block(book.value, counts, payload, marks)):
                    out.add((doc_id, at, n, ids), len(ids))
                    at += n
                    yield from out.ready()
        yield from out.rest()

    return blocks.drop("block", "block_tokens").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
