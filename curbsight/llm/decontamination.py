"""Benchmark decontamination with an FM-index per training shard.

Words of documents and benchmark items become numbers of one vocabulary, that of the benchmark: a stretch of other
words can't be part of a benchmark phrase and becomes a single "other" symbol. Every task cuts its documents into
shards of bounded size and indexes each: suffix array, Burrows-Wheeler transform as a wavelet matrix, sampled
suffix positions. All phrases (windows of ``window`` words, or a whole shorter item) are searched backwards at once,
occurrences are located by walking to the next sample, and overlapping ones are merged to removal spans.

The phrases are broadcast in blocks of at most ``BLOCK_WORDS`` benchmark words; a larger benchmark takes several passes.
A document longer than a shard is cut with an overlap of ``window - 1`` symbols, so nothing is missed at a cut.

Null and empty texts have no words; neither have such items. Repeated rows are judged one by one, a repeated item_id
counts as one item, null item ids are ignored. Extra columns of the benchmark are ignored. With an empty benchmark
every document has zero hits; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight.llm.common import stored, values

BLOCK_WORDS = 2_000_000
SHARD_SYMBOLS = 1 << 20
SAMPLE_EVERY = 8
SEPARATOR, OTHER = 0, 1

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: ASCII letters to lower case, every byte that is no part of a word to a blank.
_WORD_BYTES = bytes(b if WORD.match(bytes([b])) else 32 for b in bytes(range(256)).lower())

FOUND = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                   ("items", pa.list_(pa.int64())), ("kept_text", pa.string())])


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Phrases:
    """The distinct windows of some benchmark items as rows of numbers, by length, and who owns each."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item_id, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).add(item_id)
        self.size = len(self.vocabulary) + 2
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for length in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == length]
            self.by_length[length] = np.array(own, np.int64), [sorted(owners[p]) for p in own]

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with each stretch of other words as one, and the word position of each symbol."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(OTHER)), np.int64, len(words))
        kept = np.flatnonzero((ids != OTHER) | (np.concatenate([[0], ids[:-1]]) != OTHER))
        return ids[kept], kept


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in ascending order; every separator is smaller than the next one and all else.

    Prefix doubling in which only suffixes that are still tied are sorted again.
    """
    n = len(symbols)
    ends = symbols == SEPARATOR
    first = np.where(ends, np.cumsum(ends), symbols + int(ends.sum()))
    bits = int(first.max()).bit_length()
    depth = max(1, 62 // bits)
    padded = np.concatenate([first, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(depth):
        key = key << bits | padded[i:i + n]
    order = np.argsort(key)
    starts = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def ranked(slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The slots of ties that remain; ranks are the first slot of a tie."""
        rank[order[slots]] = np.maximum.accumulate(np.where(starts, slots, 0))
        alone = starts & np.concatenate([starts[1:], [True]])
        return slots[~alone]

    tied = ranked(np.arange(n), starts)
    while len(tied):
        at = order[tied]
        key = rank[at] * (n + 1) + rank[np.minimum(at + depth, n)] + 1
        sort = np.argsort(key)
        order[tied], key = at[sort], key[sort]
        tied = ranked(tied, np.concatenate([[True], np.diff(key) != 0]))
        depth *= 2
    return order


class FmIndex:
    """Counts and finds sequences of symbols in one shard."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]  # the last symbol is a separator and precedes the first
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.levels: list[tuple[int, np.ndarray, int]] = []
        rest, self.base = self.bwt.astype(np.int32), np.zeros(size, np.int64)
        numbers = np.arange(size)
        for level in reversed(range(max(1, (size - 1).bit_length()))):
            ones = (rest >> level & 1).astype(bool)
            zeros = np.zeros(len(rest) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            total = int(zeros[-1])
            rest = np.concatenate([rest[~ones], rest[ones]])
            self.levels.append((level, zeros, total))
            self.base = np.where(numbers >> level & 1, total + self.base - zeros[self.base], zeros[self.base])
        starts = np.concatenate([[True], symbols[:-1] == SEPARATOR])
        self.sampled = (order % SAMPLE_EVERY == 0) | starts[order]
        self.samples = order[self.sampled]
        self.sample_no = np.cumsum(self.sampled) - 1

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before a row."""
        for level, zeros, total in self.levels:
            low = zeros[at]
            at = np.where(symbol >> level & 1, total + at - low, low)
        return at - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which phrases occur, and their rows from first to before last: one step per symbol, from the end."""
        which = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.before[last], self.before[last + 1]
        for column in range(phrases.shape[1] - 2, -1, -1):
            live = high > low
            which, low, high = which[live], low[live], high[live]
            symbol = phrases[which, column]
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
        live = high > low
        return which[live], low[live], high[live]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix: step to the preceding symbol until a sample is met."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            met = self.sampled[rows]
            out[todo[met]] = self.samples[self.sample_no[rows[met]]] + steps
            todo, rows = todo[~met], rows[~met]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


class Document:
    """What is known of a document while its segments are searched."""

    def __init__(self, words: list[bytes], phrases: Phrases) -> None:
        self.n_words = len(words)
        self.symbols, self.at = phrases.symbols(words)
        self.marks = np.zeros(len(self.at) + 1, np.int64)
        self.items: set[int] = set()

    def spans(self) -> list[tuple[int, int]]:
        """Word positions of the merged occurrences."""
        hit = np.concatenate([[0], np.cumsum(self.marks[:-1]) > 0, [0]]).astype(np.int8)
        edge = np.diff(hit)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return [(int(self.at[s]), int(self.at[e - 1]) + 1) for s, e in zip(starts, ends)]


def search_shard(shard: list[tuple[Document, int, np.ndarray]], phrases: Phrases) -> None:
    """Index the segments of a shard, mark all occurrences in their documents."""
    symbols = np.concatenate([np.append(segment, SEPARATOR) for _, _, segment in shard])
    starts = np.cumsum([0] + [len(segment) + 1 for _, _, segment in shard])
    index = FmIndex(symbols, phrases.size)
    for length, (rows, owners) in phrases.by_length.items():
        which, low, high = index.search(rows)
        n = high - low
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = index.locate(np.repeat(low, n) + inside)
        whose = np.repeat(which, n)
        segment = np.searchsorted(starts, at, "right") - 1
        for s in np.unique(segment):
            doc, offset, _ = shard[s]
            mine = segment == s
            first = at[mine] - starts[s] + offset
            np.add.at(doc.marks, first, 1)
            np.add.at(doc.marks, first + length, -1)
            for phrase in np.unique(whose[mine]):
                doc.items.update(owners[phrase])


def search_documents(docs: list[Document], phrases: Phrases) -> None:
    """Cut documents into shards of at most ``SHARD_SYMBOLS`` and search those."""
    shard: list[tuple[Document, int, np.ndarray]] = []
    size, step = 0, SHARD_SYMBOLS - phrases.window + 1
    for doc in docs:
        for offset in range(0, max(len(doc.symbols) - phrases.window + 1, 1), step):
            segment = doc.symbols[offset:offset + SHARD_SYMBOLS]
            if shard and size + len(segment) > SHARD_SYMBOLS:
                search_shard(shard, phrases)
                shard, size = [], 0
            shard.append((doc, offset, segment))
            size += len(segment) + 1
    if shard:
        search_shard(shard, phrases)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode()
    where = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at:where[start][0]])
        at = where[end - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def with_found(row: T.StructField) -> T.StructType:
    return T.StructType([row, *T.StructType.fromDDL(
        "n_words long, n_hit long, spans array<struct<start:bigint,end:bigint>>, items array<bigint>, "
        "kept_text string")])


def found_batch(rows: list[pa.Array], found: list[tuple]) -> pa.RecordBatch:
    """The rows' own columns, carried along in one, with what was found in them."""
    columns = zip(*found) if found else [[]] * len(FOUND)
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays(rows), *(pa.array(c, f.type) for c, f in zip(columns, FOUND))], ["_row", *FOUND.names])


def found_row(text: str | None, n_words: int, spans: list[tuple[int, int]], items: list[int], cut_text: bool) -> tuple:
    kept = (without_spans(text, spans) if spans and text else text) if cut_text else None
    return n_words, sum(e - s for s, e in spans), [{"start": s, "end": e} for s, e in spans], items, kept


def _search(docs: DataFrame, shared: Broadcast, cut_text: bool) -> DataFrame:
    """docs: _row, _text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        waiting: list[tuple[Document, str | None]] = []
        rows: list[pa.Array] = []
        size = 0

        def finish() -> pa.RecordBatch:
            search_documents([doc for doc, _ in waiting], phrases)
            out = found_batch(rows, [found_row(text, doc.n_words, doc.spans(), sorted(doc.items), cut_text)
                                     for doc, text in waiting])
            waiting.clear()
            rows.clear()
            return out

        for batch in batches:
            begin = 0
            for i, text in enumerate(values(batch, "_text")):
                doc = Document(words_of(text), phrases)
                waiting.append((doc, text if cut_text else None))
                size += len(doc.symbols) + 1
                if size >= SHARD_SYMBOLS:
                    rows.append(batch.column(0).slice(begin, i + 1 - begin))
                    begin, size = i + 1, 0
                    yield finish()
            if begin < batch.num_rows:
                rows.append(batch.column(0).slice(begin))
        if waiting:
            yield finish()

    return docs.mapInArrow(run, with_found(docs.schema["_row"]))


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with their words, fetched and handed on in blocks of bounded size."""
    block, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    for item_id, text in items.toLocalIterator(prefetchPartitions=False):
        words = words_of(text)
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((item_id, words))
        size += len(words)
    yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = 13,
                   cut_text: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns ``keep`` of each document with n_words, n_hit, merged spans (word positions), items found.

    Columns of these names, or of ``contaminated``, that the documents have themselves are replaced. With ``cut_text`` also the text without the spans, as ``kept_text`` (null otherwise).
    """
    context = docs.sparkSession.sparkContext
    found = ["n_words", "n_hit", "spans", "items", "kept_text"]
    own = [c for c in keep if c not in (*found, "contaminated")]
    inside = [F.col(f"`{c}`") for c in own] or [F.lit(0)]
    packed = docs.select(F.struct(*inside).alias("_row"), F.col("text").alias("_text"))
    kept = [F.col(f"_row.`{c}`") for c in own]
    blocks = benchmark_blocks(benchmark, block_words)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        one = _search(packed, context.broadcast(Phrases(first, window)), cut_text)
        return one.select(*kept, *found)
    named = stored(packed.withColumn("_no", F.monotonically_increasing_id()), "named-documents")
    parts = None
    while first is not None:
        numbers = named.select(F.struct("_no").alias("_row"), "_text")
        part = _search(numbers, context.broadcast(Phrases(first, window)), False).where("n_hit > 0")
        parts = part if parts is None else parts.unionByName(part)
        first, second = second, next(blocks, None)
    by_row = parts.groupBy(F.col("_row._no").alias("_no")).agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return _merged(named.join(by_row, "_no", "left"), cut_text).select(*kept, *found)


def _merged(joined: DataFrame, cut_text: bool) -> DataFrame:
    """Spans of several passes united."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans, items in zip(*(values(batch, c) for c in ("_text", "spans", "items"))):
                united: list[tuple[int, int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans or []):
                    if united and start <= united[-1][1]:
                        united[-1] = (united[-1][0], max(end, united[-1][1]))
                    else:
                        united.append((start, end))
                out.append(found_row(text, len(words_of(text)), united, items or [], cut_text))
            if out:
                yield found_batch([batch.column(0)], out)

    return joined.select("_row", "_text", "spans", "items").mapInArrow(run, with_found(joined.schema["_row"]))


def contaminated(found: DataFrame) -> DataFrame:
    """Adds the rule: at least one word in twenty is part of a benchmark phrase."""
    return found.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
