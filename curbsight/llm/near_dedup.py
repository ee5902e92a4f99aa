"""Near-duplicate documents by ProbMinHash.

Equal texts are one node. A node's word shingles, weighted by how often they occur, send exponential arrivals (a
Poisson process each, at the rate of its weight) to ``SLOTS`` slots; the first arrival at a slot names it. A shingle stops as
soon as its next arrival comes later than the last slot's. Two nodes agree in a slot with the probability Jaccard of
their weighted shingles. Nodes that agree in all ``ROWS`` slots of a band are candidates, and every link is verified
exactly.

No pairs are spelled out within a group:

1. Each node of a band's bucket is compared with the first node of that bucket; verified links are united.
2. In buckets that then still hold several components, blocks of nodes are compared in memory: pairs of different
   components that agree in at least ``CLOSE`` of the slots, each in the first bucket that they share, by all their
   shingles. Only links that unite two components leave the block, so at most one per node, and these are verified
   once more on the texts.

So every pair that shares a bucket is in one class, or was compared. A pair at the threshold of 0.8 shares none of the
32 buckets with a probability of 5e-8. In a bucket of several components it is also missed if it agrees in fewer than
``CLOSE`` of the slots, with 1.4e-6: together 1.5e-6 at most.

Documents without words are alike only if equal. Null texts count as empty. A class is named by its smallest doc_id; rows that
repeat both id and text are the same document. Extra columns are kept. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, KeyFilter, mix, stored, values
from curbsight.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
SLOTS = 128
ROWS = 4
#: Share of equal slots from which two nodes are verified: five standard deviations below the threshold.
CLOSE = 0.62
BLOCK_NODES = 2048

#: ASCII letters to lower case, other ASCII but digits to blanks.
_WORD_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in bytes(range(256)).lower())
_MULTIPLIER = np.uint64(0x5851F42D4C957F2D)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of five words (a shorter text is one run) and how often each occurs."""
    words = (text or "").encode().translate(_WORD_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    hashes = mix(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)))
    size = min(SHINGLE_WORDS, len(words))
    runs = hashes[:len(hashes) - size + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            runs = runs * _MULTIPLIER + hashes[i:len(hashes) - size + 1 + i]
    found, counts = np.unique(mix(runs), return_counts=True)
    return found, counts.astype(np.float64)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of ``SLOTS`` numbers per weighted set that isn't empty; all sets are served side by side."""
    sizes = [len(s) for s, _ in sets]
    element, weight = np.concatenate([s for s, _ in sets]), np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = np.full(len(sets) * SLOTS, np.inf)
    winner = np.repeat(element[np.cumsum(sizes) - sizes], SLOTS)  # of a single element, at once
    last = np.where(np.array(sizes) > 1, np.inf, 0.0)
    live = last[owner] > 0
    element, weight, owner = element[live], weight[live], owner[live]
    when, turn = np.zeros(len(element)), 0
    while len(element):
        turn += 1
        with np.errstate(over="ignore"):
            random = mix(element + np.uint64(turn) * np.uint64(0xD1342543DE82EF95))
        when = when - np.log(((random >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weight
        soon = when < last[owner]
        element, weight, owner, when, random = element[soon], weight[soon], owner[soon], when[soon], random[soon]
        slot = owner * SLOTS + (mix(random) % np.uint64(SLOTS)).astype(np.int64)
        np.minimum.at(first, slot, when)
        won = first[slot] == when
        winner[slot[won]] = element[won]
        last = np.where(last > 0, first.reshape(-1, SLOTS).max(1), 0.0)
    return (winner & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(-1, SLOTS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One number per band of each signature; equal if all slots of the band are."""
    bands = signature.astype(np.uint64).reshape(len(signature), SLOTS // ROWS, ROWS)
    keys = np.broadcast_to(np.arange(SLOTS // ROWS, dtype=np.uint64), bands.shape[:2])
    for i in range(ROWS):
        keys = mix(keys ^ bands[:, :, i] << np.uint64(8) | np.uint64(i))
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exactly: the sum over common elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    both, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][at_a], b[1][at_b]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    total = 0.0
    for ratio in np.unique(x / y):
        own = x / y == ratio
        total += x[own].sum() / (np.maximum(x, ratio * y).sum() + only_a + ratio * only_b)
    return float(total)


# --- on Spark --------------------------------------------------------------------------------


def noded(docs: DataFrame) -> DataFrame:
    """The text with its node, the long doc_id, and all columns in one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), text.alias("_text"),
                       F.col("doc_id").cast("long").alias("_id"), F.unhex(F.md5(text)).alias("node"))


def sketches(rows: DataFrame) -> DataFrame:
    """node, its slots and the keys of its bands; one row per node that has words."""
    schema = pa.schema([("node", pa.binary()), ("slots", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema, rows=2_000)
        for batch in batches:
            waiting: list[tuple] = []
            size = 0

            def flush() -> None:
                if waiting:
                    found = signatures([s for _, s in waiting])
                    for (node, _), slots, bands in zip(waiting, found, band_keys(found)):
                        out.add((node, slots.tobytes(), bands))
                waiting.clear()

            for node, text in zip(values(batch, "node"), values(batch, "_text")):
                own = shingles(text)
                if len(own[0]):
                    waiting.append((node, own))
                    size += len(own[0])
                if size > 200_000 or len(waiting) >= 512:
                    flush()
                    size = 0
                    yield from out.ready()
            flush()
        yield from out.rest()

    return rows.select("node", "_text").mapInArrow(run, "node binary, slots binary, bands array<bigint>") \
        .dropDuplicates(["node"])


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough; pairs has to be a stored table."""
    spark = pairs.sparkSession

    def texts(side: str) -> DataFrame:
        wanted = KeyFilter.of(pairs.select(F.xxhash64(side))).column(spark)
        return rows.where(wanted(F.xxhash64("node"))).select(F.col("node").alias(side), F.col("_text").alias(f"{side}_text")) \
            .dropDuplicates([side])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = None, None
        for batch in batches:
            keep = []
            for b, one, other in zip(values(batch, "b"), values(batch, "a_text"), values(batch, "b_text")):
                if b != seen:
                    seen, known = b, shingles(other)
                keep.append(probability_jaccard(shingles(one), known) >= THRESHOLD)
            chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield chosen

    joined = pairs.select("a", "b").join(texts("a"), "a").join(texts("b"), "b")
    return joined.select("a", "b", "a_text", "b_text").mapInArrow(run, "a binary, b binary")


def prints(rows: DataFrame) -> DataFrame:
    """node, 32-bit shingle hashes in ascending order and how often each occurs (empty: once)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(pa.schema([("node", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary())]))
        for batch in batches:
            for node, text in zip(values(batch, "node"), values(batch, "_text")):
                full, counts = shingles(text)
                found, at = np.unique((full >> np.uint64(32)).astype(np.uint32), return_inverse=True)
                total = np.bincount(at, counts, len(found))
                out.add((node, found.tobytes(), total.tobytes() if (total > 1).any() else b""), 4 * len(found))
                yield from out.ready()
        yield from out.rest()

    return rows.select("node", "_text").dropDuplicates(["node"]).mapInArrow(
        run, "node binary, prints binary, counts binary")


class Block:
    """Nodes of one bucket (or of two blocks of it) that are compared with each other."""

    def __init__(self, rows: list[tuple]) -> None:
        self.nodes, roots, own, band, slots, sets, counts = zip(*rows)
        self.slots = np.frombuffer(b"".join(slots), np.uint32).reshape(len(rows), SLOTS)
        self.component = np.unique(np.array(roots, dtype=object), return_inverse=True)[1]
        self.own, self.band = np.array(own), band[0]
        self.sets = [np.frombuffer(x, np.uint32) for x in sets]
        self.counts = [np.frombuffer(x) if x else None for x in counts]

    def similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Probability Jaccard of one node and several others."""
        mine = self.sets[i]
        theirs = [self.sets[j] for j in others]
        sizes = np.array([len(t) for t in theirs])
        flat = np.concatenate(theirs)
        common = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
        n = np.add.reduceat(common, np.cumsum(sizes) - sizes, dtype=np.int64)
        out = n / (len(mine) + sizes - n)
        for k, j in enumerate(others):
            if self.counts[i] is not None or self.counts[j] is not None:
                out[k] = probability_jaccard(*((self.sets[x], np.ones(len(self.sets[x])) if self.counts[x] is None
                                                else self.counts[x]) for x in (i, j)))
        return out

    def links(self, two_blocks: bool) -> Iterator[tuple]:
        """Links that unite two components. Every pair is looked at in the first band that it shares."""
        for i in range(len(self.nodes) - 1):
            others = np.flatnonzero(self.component[i + 1:] != self.component[i]) + i + 1
            if two_blocks:
                others = others[self.own[others] != self.own[i]]
            equal = self.slots[others] == self.slots[i]
            close = equal.mean(1) >= CLOSE
            first = equal[close].reshape(-1, SLOTS // ROWS, ROWS).all(2).argmax(1)
            others = others[close][first == self.band]
            if not len(others):
                continue
            for j in others[self.similar(i, others) >= THRESHOLD]:
                if self.component[i] != self.component[j]:
                    self.component[self.component == self.component[j]] = self.component[i]
                    yield self.nodes[j], self.nodes[i]


def close_pairs(open_rows: DataFrame) -> DataFrame:
    """Links between components of open buckets (bucket, band, node, root, slots, prints, counts).

    A bucket is split into blocks, and every pair of blocks is compared on its own, so a task holds two blocks
    of at most about ``BLOCK_NODES`` rows at a time.
    """
    sizes = open_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counted = open_rows.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK_NODES).cast("int"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # Block i meets every block j; a row goes to the groups (min(i, j), max(i, j)).
    dealt = counted.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    group = ["bucket", "low", "high"]
    columns = ["node", "root", "own", "band", "slots", "prints", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(pa.schema([("a", pa.binary()), ("b", pa.binary())]))
        now, rows = None, []

        def compare() -> None:
            if len(rows) > 1:
                for link in Block(rows).links(now[1] != now[2]):
                    out.add(link)
            rows.clear()

        for batch in batches:
            keys = zip(*(values(batch, c) for c in group))
            for key, row in zip(keys, zip(*(values(batch, c) for c in columns))):
                if key != now:
                    compare()
                    now = key
                rows.append(row)
            yield from out.ready()
        compare()
        yield from out.rest()

    together = dealt.select(*group, *columns).repartition(*group).sortWithinPartitions(*group, "node")
    return together.mapInArrow(run, "a binary, b binary").distinct()


def classes(rows: DataFrame) -> DataFrame:
    """(node, root) of all nodes that are linked to another one."""
    spark = rows.sparkSession
    sketched = stored(sketches(rows), "sketches")
    banded = sketched.select("node", F.posexplode("bands").alias("band", "bucket"))
    heads = stored(banded.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").drop("n"), "bucket-heads")
    shared = KeyFilter.of(heads.select("bucket")).column(spark)
    together = stored(banded.where(shared("bucket")).join(heads, "bucket"), "buckets")
    spokes = stored(together.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(),
                    "spokes")
    links = stored(verified(spokes, rows), "verified-links")
    roots = stored(components(links), "components")

    named = together.select("bucket", "band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stored(named, "named-buckets")
    still_open = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")) \
        .where("low != high").select("bucket")
    open_rows = stored(named.join(still_open, "bucket"), "open-buckets")
    in_question = KeyFilter.of(open_rows.select(F.xxhash64("node"))).column(spark)
    sets = prints(rows.where(in_question(F.xxhash64("node"))))
    rest = stored(close_pairs(open_rows.join(sketched.select("node", "slots").join(sets, "node"), "node")),
                  "close-pairs")
    more = stored(verified(rest, rows), "more-links")
    if more.isEmpty():
        return roots
    return stored(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
                             .where("a != b").unionByName(more)), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """All columns with ``class_id`` (the smallest doc_id of the class) and ``kept`` (it is that document), which replace
    columns of these names.
    """
    rows = noded(docs)
    roots = classes(rows)
    member = stored(rows.select("_id", "node").join(roots, "node", "left")
                    .select("_id", "node", F.coalesce("root", "node").alias("root")), "members")
    first = member.groupBy("root").agg(F.min(F.struct("_id", "node")).alias("first")) \
        .select("root", F.col("first._id").alias("first_id"), F.col("first.node").alias("first_node"))
    # Ids are unique as a rule; where they repeat, the text tells the rows apart.
    marked = member.join(first, "root").select(
        F.col("_id").alias("m_id"), F.col("node").alias("m_node"), F.col("first_id").alias("class_id"),
        (F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node"))).alias("kept")) \
        .dropDuplicates(["m_id", "m_node"])
    joined = rows.join(marked, (F.col("node") == F.col("m_node")) & F.col("_id").eqNullSafe(F.col("m_id")))
    names = [c for c in docs.columns if c not in ("class_id", "kept")]
    return joined.select(*(F.col(f"_row.`{c}`") for c in names), "class_id", "kept")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, with its columns."""
    rows = noded(docs)
    roots = classes(rows)
    member = rows.select("_id", "node").join(roots, "node", "left") \
        .select("_id", "node", F.coalesce("root", "node").alias("root"))
    first = stored(member.groupBy("root").agg(F.min(F.struct("_id", "node")).alias("first"))
                   .select(F.col("first._id").alias("m_id"), F.col("first.node").alias("m_node")), "kept-documents")
    joined = rows.join(first, (F.col("node") == F.col("m_node")) & F.col("_id").eqNullSafe(F.col("m_id")))
    once = joined.dropDuplicates(["_id", "node"])
    return once.select(*(F.col(f"_row.`{c}`") for c in docs.columns))
