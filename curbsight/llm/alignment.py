"""Alignment of two tokenizers over a corpus: which tokens of one stand for which tokens of the other.

Both tokenizers give the same bytes, so byte offsets where tokens of both end cut a text into groups, and two tokens are
linked where their byte ranges overlap. Between two neighbouring ends, of whichever tokenizer, lies exactly one token of
each, so the links of a text are its ends. The count of an id pair is the number of its links in the whole corpus.

Most of it is the identity: a group of one token each. An array that is made once maps each id of A to the id of B with the
same bytes; groups that it explains are counted in a vector of the length of the vocabulary, one per task. Only links of
other groups go through a shuffle, summed up per chunk of documents first:

1. Texts are tokenized once. A chunk of about ``CHUNK_LINKS`` links is stored with its documents' links as numbers of
   its own distinct pairs and with the times it has each pair.
2. Times and vectors are summed per pair; the largest count per id of B follows from that.
3. A chunk gets back the counts of its own pairs by a join, and the vectors' counts (at most one number per id of A) by a
   broadcast. So it adds up its documents.

The rows exchanged are the distinct pairs of the chunks, which grow with the corpus in proportion. A pair that all
chunks have is one row per chunk, and adaptive execution splits its join.

Texts that are null, empty or not given back byte by byte by a tokenizer have no tokens. Repeated rows count each, ids may
be null, very long texts are one document of a chunk of their own length, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, RowNames, packed, stored, unpacked, values
from curbsight.llm.tokens import byte_letters

#: Links after which a chunk is closed, and characters that are aligned at once.
CHUNK_LINKS = 2_000_000
BATCH_CHARS = 2_000_000

#: Code points up to here are compared between the two libraries when a worker begins; texts beyond go the long way.
PROBED = 0x2500

#: Fixed value: how byte-level tokenizers split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """A byte-level BPE file: ids of texts, bytes of ids. Strings of special tokens are plain text.

    Where the ids of the file follow the order of its merges, the merges are the ranks of a faster library. Splitting
    depends on the tables of letters that a library has, so both are compared on every code point that the faster
    way is used for.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], {c: b for b, c in byte_letters().items()}
        self.bytes = [b""] * (1 + max(model["vocab"].values()))
        for token, number in model["vocab"].items():
            self.bytes[number] = (bytes(letters[c] for c in token) if all(c in letters for c in token)
                                  else token.encode())
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        before = spec.get("pre_tokenizer") or {}
        self.fast = None
        if (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                and not spec.get("normalizer") and model["type"] == "BPE"
                and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                   "end_of_word_suffix", "ignore_merges"))
                and all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges))):
            import tiktoken

            self.fast = tiktoken.Encoding(
                "ranks", pat_str=PATTERN, special_tokens={},
                mergeable_ranks={self.bytes[i]: i for i in range(256 + len(merges))})
            probes = [f"x{chr(c)}x 1{chr(c)}1 .{chr(c)}. {chr(c)}{chr(c)} '{chr(c)}" for c in range(PROBED)]
            long_way = self.tokenizer.encode_batch(probes, add_special_tokens=False)
            other = [chr(c) for c, p in enumerate(probes) if self.fast.encode_ordinary(p) != long_way[c].ids]
            self.unproven = re.compile(f"[{re.escape(''.join(other))}{chr(PROBED)}-\U0010ffff]")

    def encode(self, text: str) -> list[int]:
        if self.fast and not self.unproven.search(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """A piece model: ids of texts, bytes of ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.plain = [], []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())
            self.plain.append(not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)
                                   or self.model.is_unused(i)))

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def identity(a: ByteBpe, b: Pieces) -> np.ndarray:
    """For each id of A the id of B with the same bytes, whole pieces before single bytes; -1 where there is none."""
    same: dict[bytes, int] = {}
    for i in sorted(range(len(b.bytes)), key=lambda i: (not b.plain[i], i)):
        if b.plain[i] or b.model.is_byte(i):
            same.setdefault(b.bytes[i], i)
    return np.array([same.get(x, -1) if x else -1 for x in a.bytes], np.int64)


class Pair:
    """Both tokenizers with what follows from them, one per Python worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteBpe(path_a), Pieces(path_b)
        self.same = identity(self.a, self.b)
        self.width_a, self.width_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        n, m = len(self.a.bytes), len(self.b.bytes)
        # Ids as text with what follows them: A between, A at the end of its side, B between, at the end, at the very end.
        self.shown = [f"{i}{mark}".encode() for mark, k in ((",", n), ("|", n), (",", m), (";", m), ("", m))
                      for i in range(k)]

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both; none if the text isn't given back."""
        if not text:
            return [], []
        one, two = self.a.encode(" " + text), self.b.encode(text)
        whole = (" " + text).encode()
        if (b"".join(map(self.a.bytes.__getitem__, one)) != whole
                or b"".join(map(self.b.bytes.__getitem__, two)) != whole):
            return [], []
        return one, two


@functools.lru_cache(maxsize=2)
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Aligned:
    """Links and groups of some documents, found at once over all their bytes one after another."""

    def __init__(self, pair: Pair, texts: list[str | None]) -> None:
        both = [pair.tokens(t) for t in texts]
        self.n_a = np.array([len(x) for x, _ in both], np.int64)
        self.n_b = np.array([len(y) for _, y in both], np.int64)
        a = np.array([i for x, _ in both for i in x], np.int64)
        b = np.array([i for _, y in both for i in y], np.int64)
        end_a, end_b = np.cumsum(pair.width_a[a]), np.cumsum(pair.width_b[b])
        mark = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        ends = np.flatnonzero(mark)
        kind = mark[ends]
        is_a, is_b, cut = kind & 1 > 0, kind & 2 > 0, kind == 3
        upto_a, upto_b = np.cumsum(is_a), np.cumsum(is_b)
        self.a, self.b = a[upto_a - is_a], b[upto_b - is_b]  # the tokens that a stretch between two ends lies in
        group = np.cumsum(cut) - cut
        last = np.flatnonzero(cut)
        alone = np.diff(last, prepend=-1) == 1
        self.regular = alone[group] & (pair.same[self.a] == self.b) if len(last) else np.zeros(0, bool)
        # Links and groups up to the end of each document; documents end with a cut.
        done = np.cumsum(self.n_a)
        byte_end = np.where(done > 0, end_a[done - 1], 0) if len(a) else np.zeros(len(texts), np.int64)
        self.links_upto = np.searchsorted(ends, byte_end, "right")
        groups_upto = np.searchsorted(ends[last], byte_end, "right")
        self.n_links = np.diff(self.links_upto, prepend=0)
        self.n_groups = np.diff(groups_upto, prepend=0)
        self.sha = self._listed(pair, a, b, group[is_a], group[is_b], cut[is_a], cut[is_b], upto_a[last], upto_b[last])

    def _listed(self, pair, a, b, group_a, group_b, end_a, end_b, a_upto, b_upto) -> list[str]:
        """SHA-256 of the groups as text: within a group first A's ids, then B's."""
        n, m = len(pair.a.bytes), len(pair.b.bytes)
        order = np.zeros(len(a) + len(b), np.int64)
        if len(a):
            b_before = np.append(0, b_upto[:-1])
            order[np.arange(len(a)) + b_before[group_a]] = a + np.where(end_a, n, 0)
            very_last = np.zeros(len(b), bool)
            very_last[np.cumsum(self.n_b)[self.n_b > 0] - 1] = True
            order[np.arange(len(b)) + a_upto[group_b]] = 2 * n + b + np.where(very_last, 2 * m, np.where(end_b, m, 0))
        shown, out, at = list(map(pair.shown.__getitem__, order.tolist())), [], 0
        for size in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256(b"".join(shown[at:at + size])).hexdigest() if size else "")
            at += size
        return out


# --- chunks ----------------------------------------------------------------------------------

#: A row without a chunk number carries a task's vector.
CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("shas", pa.list_(pa.string())),
    ("regular", pa.binary()), ("irregular", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
])
CHUNK_SHAPE = ("chunk long, doc_ids array<long>, sizes binary, shas array<string>, regular binary, irregular binary, "
               "pairs array<long>, times array<long>")
DOCUMENTS = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in (
    "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])
DOCUMENT_SHAPE = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                  "groups_sha256 string")


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def _counted(doc: np.ndarray, number: np.ndarray, n_docs: int) -> bytes:
    """Numbers per document, each once with its times, in ascending order as steps."""
    keys, times = np.unique(doc << 32 | number, return_counts=True)
    of, number = keys >> 32, keys & 0xFFFFFFFF
    steps = np.diff(number, prepend=0)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    steps[first] = number[first]
    parts = packed(np.bincount(of, minlength=n_docs).astype(np.uint32)), packed(steps.astype(np.uint32)), packed(
        times.astype(np.uint32))
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _uncounted(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many numbers each document has, the numbers, their times."""
    parts, at = [], 0
    for _ in range(3):
        size = int.from_bytes(data[at:at + 8], "little")
        parts.append(unpacked(data[at + 8:at + 8 + size], np.uint32).astype(np.int64))
        at += 8 + size
    sizes, steps, times = parts
    sums = np.cumsum(steps)
    begin = np.cumsum(sizes) - sizes
    some = begin[sizes > 0]
    return sizes, sums - np.repeat(sums[some] - steps[some], sizes[sizes > 0]), times


class Chunk:
    def __init__(self) -> None:
        self.ids: list = []
        self.parts: list[Aligned] = []
        self.links = 0

    def add(self, ids: list, aligned: Aligned) -> None:
        self.ids += ids
        self.parts.append(aligned)
        self.links += len(aligned.a)

    def row(self, name: int, pair: Pair, vector: np.ndarray) -> tuple:
        sizes = np.concatenate([np.stack([p.n_a, p.n_b, p.n_groups, p.n_links]) for p in self.parts], 1)
        a, b = (np.concatenate([getattr(p, side) for p in self.parts]) for side in "ab")
        regular = np.concatenate([p.regular for p in self.parts])
        doc = np.repeat(np.arange(sizes.shape[1]), sizes[3])
        vector += np.bincount(a[regular], minlength=len(vector))
        other = ~regular
        pairs, number, times = np.unique(pair_key(a[other], b[other]), return_inverse=True, return_counts=True)
        return (name, self.ids, packed(sizes.ravel()), [s for p in self.parts for s in p.sha],
                _counted(doc[regular], a[regular], sizes.shape[1]), _counted(doc[other], number.ravel(), sizes.shape[1]),
                pairs, times)


def _portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of about so many characters."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(values(batch, "doc_id"), values(batch, "text")):
            ids.append(doc_id)
            texts.append(text)
            chars += len(text or "") + 1
            if chars >= size:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def align_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Chunks of aligned documents, and a row per task with its vector of identical pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, names, out = pair_of(path_a, path_b), RowNames(), Emitter(CHUNKS, rows=1)
        vector, chunk = np.zeros(len(pair.a.bytes), np.int64), Chunk()
        for ids, texts in _portions(batches, BATCH_CHARS):
            chunk.add(ids, Aligned(pair, texts))
            if chunk.links >= chunk_links:
                out.add(chunk.row(names.take(), pair, vector))
                yield from out.ready()
                chunk = Chunk()
        if chunk.ids:
            out.add(chunk.row(names.take(), pair, vector))
            yield from out.ready()
        seen = np.flatnonzero(vector)
        out.add((None, None, None, None, None, None, pair_key(seen, pair.same[seen]), vector[seen]))
        yield from out.rest()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, CHUNK_SHAPE)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair`` (id of A times 2^32 plus id of B), ``n`` over the corpus, ``best``: no pair of its B id has more."""
    times = chunks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = times.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    counts = stored(counts.withColumn("b", F.expr("cast(pair & 4294967295 as int)")), "pair-counts")
    # One row per id of B: bounded by the vocabulary.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Per document of ``doc_id`` and ``text``: numbers of tokens, groups and links, how many links are the most frequent
    ones of their B id, the sum of the counts of all links, and a digest of the groups.
    """
    chunks = stored(align_chunks(docs, path_a, path_b, chunk_links), "alignment")
    counts = stored(pair_counts(chunks), "pair-best")
    pair = pair_of(path_a, path_b)
    some = np.flatnonzero(pair.same >= 0)
    same = spark.createDataFrame([(int(k),) for k in pair_key(some, pair.same[some])], "pair long")
    totals, best = np.zeros(len(pair.same), np.int64), np.zeros(len(pair.same), np.int64)
    for row in counts.join(F.broadcast(same), "pair").collect():  # at most one row per id of A
        totals[row["pair"] >> 32], best[row["pair"] >> 32] = row["n"], row["best"]
    shared = spark.sparkContext.broadcast((totals, best))

    real = chunks.where("chunk is not null")
    asked = real.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(counts, "pair").groupBy("chunk").agg(F.collect_list(F.struct("place", "n", "best")).alias("told"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, best = shared.value
        out = Emitter(DOCUMENTS)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield from _documents(row, totals, best, out)
        yield from out.rest()

    return real.drop("pairs", "times").join(told, "chunk", "left").drop("chunk").mapInArrow(finish, DOCUMENT_SHAPE)


def _documents(row: pa.RecordBatch, totals: np.ndarray, best: np.ndarray, out: Emitter) -> Iterator[pa.RecordBatch]:
    """The documents of one chunk with the counts that it was told."""
    answers = row.column(row.schema.get_field_index("told")).flatten()
    place, n, is_best = (answers.field(k).to_numpy(zero_copy_only=False) for k in ("place", "n", "best"))
    own_n, own_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    own_n[place], own_best[place] = n, is_best
    ids, shas = values(row, "doc_ids")[0], values(row, "shas")[0]
    sizes = unpacked(values(row, "sizes")[0], np.int64).reshape(4, len(ids))
    sums = np.zeros((2, len(ids)), np.int64)
    for name, table_n, table_best in (("regular", totals, best), ("irregular", own_n, own_best)):
        per_doc, number, times = _uncounted(values(row, name)[0])
        end = np.cumsum(per_doc)
        for k, table in ((0, table_best), (1, table_n)):
            upto = np.append(0, np.cumsum(table[number] * times))
            sums[k] += upto[end] - upto[end - per_doc]
    for found in zip(ids, *sizes.tolist(), *sums.tolist(), shas):
        out.add(found)
        yield from out.ready()
