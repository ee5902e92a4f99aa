"""Line deduplication by winnowing: later copies of repeated runs are deleted from the texts.

A copied passage seldom keeps its place in the lines of a text, so the text is wrapped anew at every word: the line
at a word is the ``LINE_WORDS`` words from there on. Of every window of ``WINDOW`` neighbouring lines the one with the
smallest hash is a fingerprint. It depends on the window's words alone, so any two equal runs of ``RUN_WORDS`` words have
the same one in the window that they begin with. A run can only occur twice if that line does.

1. Fingerprints that occur more than once go to a Bloom filter, which thins out what follows.
2. Each run of ``RUN_WORDS`` words that begins with such a window is named by a 64-bit hash. Of the runs with one name in a
   chunk of texts all but the first are cut; the first goes to a bucket by its name.
3. A bucket sends those back for which another chunk has an earlier text. So every run is compared with all others of
   its kind, whatever else the texts around share, and a passage in n texts gives one row per chunk.
4. The words of all repeated runs are cut from the later text.

Texts are ordered by doc_id (nulls first), then by content, then by place. Rows that are equal in doc_id and text are one text to this
operator: they all keep or lose the same runs. Null texts stay null; texts that repeat as a whole become empty, no row is
dropped. Extra columns are kept. Words are what stands between ASCII blanks, compared byte by byte.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight.llm.common import Emitter, KeyFilter, RowNames, by_bucket, mix, packed, raw_texts, stored, unpacked, values

LINE_WORDS = 16
WINDOW = 32
RUN_WORDS = 50
#: Candidate runs after which a chunk of texts is closed, and candidate runs of the corpus for each bucket.
CHUNK_RUNS = 500_000
BUCKET_RUNS = 1_000_000
PAGE_WORDS = 64
#: Pages that are compared at once, as far as they belong to different diagonals.
PAGES_AT_ONCE = 2048

_MULTIPLIER = 0x5851F42D4C957F2D
_POWERS = [np.uint64(pow(_MULTIPLIER, n, 1 << 64)) for n in (1, 2, 4, 8)]
_BLANK = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def word_hashes(raw: bytes) -> np.ndarray:
    words = raw.split()
    return np.maximum(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)), 1)  # 0: no word


def line_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the sixteen words from each word on, by doubling."""
    lines = words.astype(np.uint64)
    size = 1
    with np.errstate(over="ignore"):
        for power in _POWERS:
            lines = lines[:-size] * power + lines[size:]
            size *= 2
    return mix(lines)


def run_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the ``RUN_WORDS`` words from each word on, put together from runs of a power of two."""
    power, of_size, size = _MULTIPLIER, words.astype(np.uint64), 1
    out, done = np.zeros(len(words) - RUN_WORDS + 1, np.uint64), 0
    with np.errstate(over="ignore"):
        while size <= RUN_WORDS:
            if RUN_WORDS & size:
                out = out * np.uint64(power) + of_size[done:done + len(out)]
                done += size
            of_size = of_size[:-size] * np.uint64(power) + of_size[size:]
            power, size = power * power % (1 << 64), 2 * size
    return mix(out)


def least_lines(lines: np.ndarray) -> np.ndarray:
    """The smallest hash of each window, by doubling."""
    least = lines
    size = 1
    while size < WINDOW:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return least


def winnow(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the smallest hash of each window; how far back the same line repeats itself, and after how many words.

    Where the same line comes again within a window, the text repeats itself there. Of such a chain only the last line
    is taken, or a word that stands a thousand times in a row would match itself at as many distances.
    """
    if len(lines) < WINDOW:
        return (np.zeros(0, np.int64),) * 3
    least = least_lines(lines)
    # A line is the smallest of some window if the largest of the minima around it is its own hash.
    around = np.concatenate([np.zeros(WINDOW - 1, lines.dtype), least, np.zeros(WINDOW - 1, lines.dtype)])
    size = 1
    while size < WINDOW:
        around = np.maximum(around[:-size], around[size:])
        size *= 2
    chosen = np.flatnonzero(around == lines)
    again = (lines[chosen[:-1]] == lines[chosen[1:]]) & (np.diff(chosen) < WINDOW)
    last, first = np.append(~again, True), np.append(True, ~again)
    before = np.diff(chosen, prepend=chosen[0]) * np.append(False, again)
    return chosen[last], chosen[last] - chosen[first], before[last]


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without runs of words; what they stood between is joined by a line feed or a blank."""
    where = [m.span() for m in _BLANK.finditer(raw)]
    edges = [0, *(x for s, e in spans for x in (where[s][0], where[e - 1][1])), len(raw)]
    out: list[bytes] = []
    blank = b""
    for start, end in zip(edges[::2], edges[1::2]):
        piece = raw[start:end]
        body = piece.strip()
        if not body:
            blank += piece
            continue
        before = blank + piece[:len(piece) - len(piece.lstrip())]
        if not out:
            out.append(before if not start else b"")
        else:
            out.append(b"\n" if b"\n" in before else b" ")
        out.append(body)
        blank = piece[len(piece.rstrip()):]
    return b"".join(out) + (raw[len(raw.rstrip()):] if out else b"")


def keyed(docs: DataFrame) -> DataFrame:
    """The text, the long doc_id, the key that names a text of a document, and all other columns in one."""
    kept = [c for c in docs.columns if c not in ("text", "n_removed")]
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_rest"), "text",
                       F.col("doc_id").cast("long").alias("_id")).withColumn("_key", F.xxhash64("_id", "text"))


def prints(docs: DataFrame) -> DataFrame:
    """print, n: the fingerprints of all texts and how often they occur; a line that repeats itself counts twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for raw in raw_texts(batch, "text"):
                lines = line_hashes(word_hashes(raw or b""))
                found, _, period = winnow(lines)
                parts.append(lines[found])
                times.append(1 + (period > 0))
            found, at = np.unique(np.concatenate(parts), return_inverse=True)
            n = np.bincount(at, np.concatenate(times), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["print", "n"])

    return docs.select("text").mapInArrow(run, "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))


def candidates(words: np.ndarray, repeated: KeyFilter) -> np.ndarray:
    """The words where a run begins whose fingerprint may occur more than once."""
    if len(words) < RUN_WORDS:
        return np.zeros(0, np.int64)
    least = least_lines(line_hashes(words))[:len(words) - RUN_WORDS + 1]
    begin = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    return np.flatnonzero(np.repeat(repeated.holds(least[begin].view(np.int64)),
                                    np.diff(begin, append=len(least))))


def runs(docs: DataFrame, repeated: KeyFilter, buckets: int) -> DataFrame:
    """Runs by bucket and chunk: their names, texts (id, whether there is one, key) and places; bucket -1: to be cut."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)
    limit = CHUNK_RUNS
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("known", pa.binary()),
                        ("ids", pa.binary()), ("keys", pa.binary()), ("pos", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_names, out = RowNames(), Emitter(schema, size=4 << 20)
        texts: dict[int, int | None] = {}
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def close() -> Iterator[tuple]:
            chunk = chunk_names.take()
            keys = np.array(list(texts), np.int64)
            known = np.array([x is not None for x in texts.values()], np.uint8)
            ids = np.array([x or 0 for x in texts.values()], np.int64)
            rank = np.empty(len(keys), np.int64)
            rank[np.lexsort((keys, ids, known))] = np.arange(len(keys))
            names, pos = (np.concatenate([p[i] for p in parts]) for i in range(2))
            text = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            order = np.lexsort((pos, rank[text], names))
            first = np.append(True, names[order[1:]] != names[order[:-1]])
            later, sent = np.sort(order[~first]), np.sort(order[first])
            if len(later):
                yield -1, chunk, None, None, None, packed(keys[text[later]]), packed(pos[later])
            order, dealt = by_bucket((mix(names[sent]) % np.uint64(buckets)).astype(np.int32))
            for bucket, begin, end in dealt:
                at = sent[order[begin:end]]
                yield (bucket, chunk, packed(names[at]), packed(known[text[at]]), packed(ids[text[at]]),
                       packed(keys[text[at]]), packed(pos[at]))

        def flush() -> Iterator[pa.RecordBatch]:
            for row in close():
                out.add(row, sum(len(x) for x in row[2:] if x))
                yield from out.ready()

        for batch in batches:
            for doc_id, key, raw in zip(values(batch, "_id"), values(batch, "_key"), raw_texts(batch, "text")):
                if not raw or key in texts:
                    continue
                words = word_hashes(raw)
                at = candidates(words, shared.value)
                if len(at):
                    texts[key] = doc_id
                    parts.append((run_hashes(words)[at], at.astype(np.uint32)))
                    n += len(at)
                if n >= limit:
                    yield from flush()
                    texts.clear()
                    parts.clear()
                    n = 0
        if parts:
            yield from flush()
        yield from out.rest()

    return docs.select("_id", "_key", "text").mapInArrow(
        run, "bucket int, chunk long, names binary, known binary, ids binary, keys binary, pos binary")


def later_runs(found: DataFrame) -> DataFrame:
    """key, starts: the words of each text where a run begins that occurred before."""
    def compare(table: pa.Table) -> pa.Table:
        names, known, ids, keys, pos = (
            [unpacked(x, kind) for x in table[c].to_pylist()] for c, kind in
            (("names", np.uint64), ("known", np.uint8), ("ids", np.int64), ("keys", np.int64), ("pos", np.uint32)))
        sizes = [len(x) for x in names]
        name, *text = (np.concatenate(x) for x in (names, known, ids, keys))
        order = np.lexsort((*reversed(text), name))
        first = np.append(True, name[order[1:]] != name[order[:-1]])
        of = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
        later = np.zeros(len(name), bool)
        later[order] = np.logical_or.reduce([x[order] != x[of] for x in text])
        parts = np.split(later, np.cumsum(sizes)[:-1])
        return pa.Table.from_arrays(
            [table["chunk"].combine_chunks(), pa.array([packed(k[x]) for k, x in zip(keys, parts)], pa.binary()),
             pa.array([packed(p[x]) for p, x in zip(pos, parts)], pa.binary())], ["chunk", "keys", "pos"])

    def merge(table: pa.Table) -> pa.Table:
        key = np.concatenate([unpacked(x, np.int64) for x in table["keys"].to_pylist()])
        pos = np.concatenate([unpacked(x, np.uint32) for x in table["pos"].to_pylist()])
        order = np.lexsort((pos, key))
        key, pos = key[order], pos[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        starts = [x.tobytes() for x in np.split(pos, begin[1:])] if len(key) else []
        return pa.Table.from_arrays([pa.array(key[begin]), pa.array(starts, pa.binary())], ["key", "starts"])

    answers = found.where("bucket >= 0").groupBy("bucket").applyInArrow(compare, "chunk long, keys binary, pos binary")
    return found.where("bucket < 0").select("chunk", "keys", "pos").unionByName(answers) \
        .groupBy("chunk").applyInArrow(merge, "key long, starts binary") \
        .groupBy("key").agg(F.max("starts").alias("starts"))  # rows of one text in several chunks agree


def spans_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """The words of the runs that begin at distinct words."""
    starts = starts.astype(np.int64)
    marks = np.zeros(starts.max() + RUN_WORDS + 1, np.int64)
    marks[starts] += 1
    marks[starts + RUN_WORDS] -= 1
    edge = np.diff(np.concatenate([[0], np.cumsum(marks) > 0]).astype(np.int8))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def repeated_spans(words: np.ndarray, other: np.ndarray, shift: np.ndarray, page: np.ndarray,
                   hashes: np.ndarray) -> list[tuple[int, int]]:
    """Words that repeat an earlier text, from the pages that were fetched for this one (one row of hashes each).

    Pages that follow each other on a diagonal are compared as one stretch. Not used by ``dedup_lines``, which compares runs.
    """
    order = np.lexsort((page, shift, other))
    other, shift, page = other[order], shift[order], page[order]
    marks = np.zeros(len(words) + 1, np.int64)
    diagonal = np.concatenate([[True], (other[1:] != other[:-1]) | (shift[1:] != shift[:-1])])
    begin = 0
    for end in [*np.flatnonzero(diagonal)[1:].tolist(), len(order)]:
        if end - begin >= PAGES_AT_ONCE or end == len(order):
            part = slice(begin, end)
            _mark(marks, words, other[part], shift[part], page[part], hashes[order[part]])
            begin = end
    hit = np.concatenate([[0], np.cumsum(marks[:-1]) > 0, [0]]).astype(np.int8)
    edge = np.diff(hit)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _mark(marks: np.ndarray, words: np.ndarray, other: np.ndarray, shift: np.ndarray, page: np.ndarray,
          hashes: np.ndarray) -> None:
    """Mark where repeated runs begin and end; the pages are those of whole diagonals, in order."""
    at = page[:, None] * PAGE_WORDS + shift[:, None] + np.arange(PAGE_WORDS)
    inside = (at >= 0) & (at < len(words))
    same = inside & (words[np.clip(at, 0, len(words) - 1)] == hashes)
    follows = (other[1:] == other[:-1]) & (shift[1:] == shift[:-1]) & (page[1:] == page[:-1] + 1)
    # One line of all pages, with a gap where a new stretch begins.
    gaps = np.concatenate([[1], ~follows]).astype(np.int64)
    slot = np.arange(same.size).reshape(same.shape) + np.cumsum(gaps)[:, None]
    line = np.zeros(same.size + int(gaps.sum()) + 1, np.int8)
    line[slot] = same
    edge = np.diff(line)
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    long = ends - starts >= RUN_WORDS
    place = np.zeros(len(line), np.int64)
    place[slot] = at
    np.add.at(marks, place[starts[long]], 1)
    np.add.at(marks, place[starts[long]] + (ends - starts)[long], -1)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns with ``text`` cut, and n_removed: how many words were cut, which replaces a column of this name."""
    spark = docs.sparkSession
    rows = keyed(docs)
    twice = stored(prints(rows).where("n > 1"), "repeated-prints")
    buckets = 4 + (twice.agg(F.sum("n")).first()[0] or 0) * WINDOW // 2 // BUCKET_RUNS
    found = stored(runs(rows, KeyFilter.of(twice.select("print")), buckets), "runs")
    served = stored(later_runs(found), "later-runs")
    touched = KeyFilter.of(served.select("key")).column(spark)

    flagged = rows.withColumn("_touched", touched("_key"))
    hit = flagged.where("_touched").join(served, F.col("_key") == F.col("key"), "left")
    schema = T.StructType([rows.schema["_rest"], T.StructField("text", T.StringType()),
                           T.StructField("n_removed", T.LongType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_removed = [], []
            for raw, starts in zip(raw_texts(batch, "text"), values(batch, "starts")):
                spans = spans_of(np.frombuffer(starts, np.uint32)) if raw and starts else []
                texts.append(cut(raw, spans) if spans else raw)
                n_removed.append(sum(e - s for s, e in spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_removed, pa.int64())],
                schema.names)

    cleaned = hit.select("_rest", "text", "starts").mapInArrow(clean, schema)
    whole = flagged.where("not _touched").select("_rest", "text", F.lit(0).cast("long").alias("n_removed"))
    return cleaned.unionByName(whole).select("_rest.*", "text", "n_removed")
