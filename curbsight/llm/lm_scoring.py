"""Cross-entropy difference of two matched n-gram language models.

The target model is counted on a chosen part of the corpus, the background model on the rest, over one shared
vocabulary: all tokens of the whole corpus, however rare (``VOCABULARY`` can bound it to the most frequent ones, then
everything else is one unknown token). Both are bigram models over all documents of their part, smoothed alike: the
bigram's share is mixed with the token's own (Dirichlet prior of weight ``PRIOR``), which is smoothed by adding one. The
models are matched in size too: counts of the larger part are scaled to the tokens of the smaller one, so that smoothing
weighs the same in both. No document is judged by itself: its own counts are taken out of the model that has them. A
document's score is the mean over its tokens and its end of the loss under the target model less that under the
background model, in bits: the lower, the more the document is like the target.

The model grows with the corpus, so it is never in one place. Documents are cut into chunks of about a million tokens, and
a chunk and a bucket of the model exchange what the chunk has of the bucket:

1. Chunks are stored as numbers of their own tokens. Each distinct token of a chunk is sent to its bucket, which gives it a
   number in the corpus and says whether other chunks have it too.
2. A chunk adds up its tokens and bigrams in both parts and sends the sums to their buckets, which send back the sums over
   all chunks in the same order. What has a token that no other chunk has is complete already and isn't sent.
3. The chunk's documents are scored by these sums.

A frequent word pair is one entry per chunk. The driver receives the number of distinct tokens and of all tokens.

Tokens are runs of letters, digits and other bytes of words in lower case, and runs of other ASCII marks. A null or empty text has
one token, its end. Repeated rows count each; null ids and labels make a document background. Extra columns are
ignored. With an empty part its model knows only the prior; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, RowNames, by_bucket, mix, packed, stored, unpacked, values

#: How many of the most frequent tokens are told apart; None: all.
VOCABULARY: int | None = None
PRIOR = 50.0
EDGE, UNKNOWN = 0, 1
#: Distinct tokens that a task holds before it sends their counts.
HELD_TOKENS = 500_000
#: Tokens after which a chunk is closed, and tokens of the corpus for each bucket of the model.
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 2_000_000
#: Stands for the second token in the key of a single token.
ALONE = np.uint64(0xFFFFFFFF)

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\x00-\x20\x7f0-9a-z\x80-\xff]+")

_CHUNK = "chunk long, n_tokens long, doc_ids array<long>, sizes binary, ids binary, tokens binary"


def tokens(text: str | None) -> list[bytes]:
    return TOKEN.findall((text or "").encode().lower())


def count_tokens(docs: DataFrame) -> DataFrame:
    """token, n over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                               pa.array(list(counts.values()), pa.int64())], ["token", "n"])
            counts.clear()
            return rows

        for batch in batches:
            for text in values(batch, "text"):
                counts.update(tokens(text))
                if len(counts) > HELD_TOKENS:
                    yield flush()
        if counts:
            yield flush()

    return docs.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int | None = VOCABULARY) -> frozenset[bytes] | None:
    """The ``size`` most frequent tokens, of equal counts the first in order of the token; None: all tokens."""
    if size is None:
        return None
    top = count_tokens(docs).orderBy(F.desc("n"), "token").limit(size).collect()
    return frozenset(bytes(r["token"]) for r in top)


class Numbers(dict):
    """Numbers in the order in which keys are asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def packed_words(words: list[bytes]) -> bytes:
    """Tokens, none of which has a blank or a line feed."""
    data = b"\n".join(words)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked_words(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True).split(b"\n")


def chunks(docs: DataFrame, known: frozenset[bytes] | None) -> DataFrame:
    """Documents as numbers of the tokens of their chunk, each with an edge at its end."""
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(known)
    limit = CHUNK_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = RowNames()
        schema = pa.schema([("chunk", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("sizes", pa.binary()), ("ids", pa.binary()), ("tokens", pa.binary())])
        numbers, doc_ids, parts, n = Numbers(), [], [], 0

        def fresh() -> Numbers:
            return Numbers({b"\n": EDGE, b" ": UNKNOWN})  # neither can be a token

        def close() -> pa.RecordBatch:
            sizes = np.array([len(p) for p in parts], np.uint32)
            row = (names.take(), n, doc_ids, packed(sizes), packed(np.concatenate(parts)),
                   packed_words(list(numbers)[2:]))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        numbers = fresh()
        for batch in batches:
            for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
                found = tokens(text)
                if shared is not None:
                    found = [t if t in shared.value else b" " for t in found]
                found.append(b"\n")
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                doc_ids.append(doc_id)
                n += len(found)
                if n >= limit:
                    yield close()
                    numbers, doc_ids, parts, n = fresh(), [], [], 0
        if parts:
            yield close()

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _CHUNK), "chunks")


def small(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint32)


def token_buckets(found: list[bytes], buckets: int) -> np.ndarray:
    return small(np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) % buckets, buckets)


def number_tokens(held: DataFrame, buckets: int) -> DataFrame:
    """A row per chunk: for each bucket the corpus numbers of the chunk's tokens and whether others have them."""
    sent = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("tokens", pa.binary())])
    back = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("numbers", pa.binary()),
                      ("alone", pa.binary()), ("n_distinct", pa.int64())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(sent)
        for batch in batches:
            for chunk, data in zip(values(batch, "chunk"), values(batch, "tokens")):
                found = [t for t in unpacked_words(data) if t]
                order, dealt = by_bucket(token_buckets(found, buckets))
                for bucket, begin, end in dealt:
                    words = packed_words([found[i] for i in order[begin:end].tolist()])
                    out.add((bucket, chunk, words), len(words))
                    yield from out.ready()
        yield from out.rest()

    def number(table: pa.Table) -> pa.Table:
        at, rows = Numbers(), []
        for data in table["tokens"].to_pylist():
            found = unpacked_words(data)
            rows.append(np.fromiter(map(at.__getitem__, found), np.int64, len(found)))
        alone = np.bincount(np.concatenate(rows)) == 1
        bucket = table["bucket"][0].as_py()
        if 2 + len(at) * buckets >= int(ALONE):
            raise OverflowError("more tokens than numbers of 32 bits")
        return pa.Table.from_arrays(
            [table["bucket"].combine_chunks(), table["chunk"].combine_chunks(),
             pa.array([packed((2 + r * buckets + bucket).astype(np.uint32)) for r in rows], pa.binary()),
             pa.array([packed(alone[r].astype(np.uint8)) for r in rows], pa.binary()),
             pa.array([len(at)] * len(rows), pa.int64())], schema=back)

    answers = held.select("chunk", "tokens").mapInArrow(send, "bucket int, chunk long, tokens binary") \
        .groupBy("bucket").applyInArrow(number, "bucket int, chunk long, numbers binary, alone binary, n_distinct long")
    return stored(answers.groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "numbers", "alone", "n_distinct")).alias("numbered")), "token-numbers")


def marked(held: DataFrame, labels: DataFrame, condition: Column) -> DataFrame:
    """A row per chunk with documents whose label fulfils the condition: their places (targets) and n_target tokens.

    Labels grow with the documents, so they are merged and never broadcast, however few they are.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, sizes in zip(values(batch, "chunk"), values(batch, "doc_ids"), values(batch, "sizes")):
                n = unpacked(sizes, np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), chunk)), pa.array(np.arange(len(n), dtype=np.int32)),
                     pa.array(ids, pa.int64()), pa.array(n.astype(np.int64))], ["chunk", "place", "doc_id", "n"])

    wanted = labels.where(condition).select(F.col("doc_id").alias("_target_id")).distinct().hint("merge")
    found = held.select("chunk", "doc_ids", "sizes").mapInArrow(places, "chunk long, place int, doc_id long, n long")
    return stored(
        found.join(wanted, F.col("doc_id") == F.col("_target_id")).groupBy("chunk").agg(
            F.collect_list("place").alias("targets"), F.sum("n").alias("n_target")), "targets")


class Chunk:
    """A chunk's distinct bigrams and tokens, how often either part has them, and what it exchanges with buckets."""

    def __init__(self, row: dict, buckets: int) -> None:
        self.sizes, self.ids = unpacked(row["sizes"], np.uint32), unpacked(row["ids"], np.uint32)
        found = [t for t in unpacked_words(row["tokens"]) if t]
        size = len(found) + 2
        number, alone = np.zeros(size, np.uint64), np.zeros(size, bool)
        number[UNKNOWN] = UNKNOWN
        order, dealt = by_bucket(token_buckets(found, buckets))
        answers = {x["bucket"]: x for x in row["numbered"] or []}
        for bucket, begin, end in dealt:
            at = 2 + order[begin:end]
            number[at] = unpacked(answers[bucket]["numbers"], np.uint32)
            alone[at] = unpacked(answers[bucket]["alone"], np.uint8) > 0

        self.is_target = np.zeros(len(self.sizes), bool)
        self.is_target[np.array(row["targets"] or [], np.int64)] = True
        wanted = np.repeat(self.is_target, self.sizes)
        before = np.concatenate([[EDGE], self.ids[:-1]]).astype(np.int64)
        self.pair = before * size + self.ids
        self.pairs, in_all = np.unique(self.pair, return_counts=True)
        here, in_target = np.unique(self.pair[wanted], return_counts=True)
        self.first, self.second = self.pairs // size, self.pairs % size
        # Rows: all, target. The sums of single tokens stand behind those of the bigrams.
        self.sums = np.zeros((2, len(self.pairs) + size), np.int64)
        self.sums[0, :len(self.pairs)] = in_all
        self.sums[1, np.searchsorted(self.pairs, here)] = in_target
        self.sums[0, len(self.pairs):] = np.bincount(self.ids, minlength=size)
        self.sums[1, len(self.pairs):] = np.bincount(self.ids[wanted], minlength=size)

        shared = np.concatenate([~(alone[self.first] | alone[self.second]), ~alone & (self.sums[0, -size:] > 0)])
        key = np.concatenate([number[self.first] << np.uint64(32) | number[self.second],
                              number << np.uint64(32) | ALONE])
        at = np.flatnonzero(shared)
        at = at[np.argsort(key[at])]
        order, self.dealt = by_bucket(small(mix(key[at]) % np.uint64(buckets), buckets))
        #: Places in ``sums`` of what is exchanged, and their keys, ascending in each bucket.
        self.at = at[order]
        self.key = key[self.at]

    def losses(self, total: tuple[int, int], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean losses of the documents in bits under both models. total: tokens of the target and of the background.

        A document's own counts are taken out of the model of its part, and the larger part is scaled to the smaller one.
        """
        n_pairs, out = len(self.pairs), []
        start = np.concatenate([[0], np.cumsum(self.sizes[:-1], dtype=np.int64)])
        doc = np.repeat(np.arange(len(self.sizes), dtype=np.int64), self.sizes)
        place = np.searchsorted(self.pairs, self.pair)
        first, second = self.first[place], self.second[place]
        own_pair = own_counts(doc * n_pairs + place)
        width = len(self.sums[0]) - n_pairs
        own_second = own_counts(doc * width + second)
        # How often a document begins a bigram with a token is how often it has the token: its end stands for its begin.
        own_first = np.where(first == EDGE, 1, np.concatenate([[1], own_second[:-1]]))
        in_target = self.is_target[doc]
        for sums, n, inside in ((self.sums[1], total[0], in_target), (self.sums[0] - self.sums[1], total[1], ~in_target)):
            scale = min(total) / n if min(total) else 1.0
            token = sums[n_pairs:]
            share = (scale * (token[second] - own_second * inside) + 1) / (
                scale * (n - self.sizes[doc].astype(np.int64) * inside) + size)
            loss = -np.log2((scale * (sums[place] - own_pair * inside) + PRIOR * share)
                            / (scale * (token[first] - own_first * inside) + PRIOR))
            out.append(np.add.reduceat(loss, start) / self.sizes)
        return out[0], out[1]


def own_counts(keys: np.ndarray) -> np.ndarray:
    """How often each entry occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(begin, len(keys)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(n, n)
    return out


def summed(whole: DataFrame, buckets: int) -> DataFrame:
    """A row per chunk: for each bucket the sums over all chunks of what the chunk has of it, in the chunk's order."""
    sent = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()),
                      ("n_target", pa.binary())])
    back = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.binary()), ("n_target", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(sent, size=4 << 20)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, buckets)
                for bucket, begin, end in chunk.dealt:
                    keys = packed(np.diff(chunk.key[begin:end], prepend=np.uint64(0)))
                    n, n_target = (packed(x.astype(np.uint32)) for x in chunk.sums[:, chunk.at[begin:end]])
                    out.add((bucket, row["chunk"], keys, n, n_target), len(keys) + len(n) + len(n_target))
                    yield from out.ready()
        yield from out.rest()

    def add_up(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(x) for x in keys])
        columns = []
        for name in ("n", "n_target"):
            own = np.concatenate([unpacked(x, np.uint32) for x in table[name].to_pylist()])
            total = np.bincount(at, own, len(found)).astype(np.int64)  # whole numbers below 2**53 are exact
            columns.append(pa.array([packed(total[x]) for x in np.split(at, ends[:-1])], pa.binary()))
        return pa.Table.from_arrays(
            [table["bucket"].combine_chunks(), table["chunk"].combine_chunks(), *columns], schema=back)

    answers = whole.mapInArrow(send, "bucket int, chunk long, keys binary, n binary, n_target binary") \
        .groupBy("bucket").applyInArrow(add_up, "bucket int, chunk long, n binary, n_target binary")
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "n_target")).alias("sums"))


def score(whole: DataFrame, buckets: int, total: tuple[int, int], size: int) -> DataFrame:
    """doc_id, n_tokens (with the end), both cross-entropies in bits per token and their difference."""
    names = ["doc_id", "n_tokens", "target_bits", "background_bits", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, buckets)
                answers = {x["bucket"]: x for x in row["sums"] or []}
                for bucket, begin, end in chunk.dealt:
                    for k, name in enumerate(("n", "n_target")):
                        chunk.sums[k, chunk.at[begin:end]] = unpacked(answers[bucket][name], np.int64)
                target, background = chunk.losses(total, size)
                out = pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.sizes.astype(np.int64)), pa.array(target),
                     pa.array(background), pa.array(target - background)], names)
                for i in range(0, len(out), 100_000):
                    yield out.slice(i, 100_000)

    return whole.mapInArrow(
        run, "doc_id long, n_tokens long, target_bits double, background_bits double, score double")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, condition: Column) -> DataFrame:
    """Scores of all documents; the target are the documents whose label fulfils the condition."""
    held = chunks(docs, vocabulary(docs))
    n = held.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = 4 + n // BUCKET_TOKENS
    numbered, targets = number_tokens(held, buckets), marked(held, labels, condition)
    n_distinct = numbered.select(F.explode("numbered").alias("x")).groupBy("x.bucket") \
        .agg(F.max("x.n_distinct").alias("n")).agg(F.sum("n")).first()[0] or 0
    n_target = targets.agg(F.sum("n_target")).first()[0] or 0
    # Never broadcast, however few they are: all of it grows with the corpus.
    whole = held.join(numbered.hint("merge"), "chunk", "left").join(targets.drop("n_target").hint("merge"), "chunk", "left")
    sums = stored(summed(whole, buckets), "sums")
    return score(whole.join(sums.hint("merge"), "chunk", "left"), buckets, (n_target, n - n_target), n_distinct + 2)
