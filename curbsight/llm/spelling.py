"""Spelling variants: words at one edit from each other, by composition of finite-state machines.

The pairs are what the composition of three machines accepts: the minimised acceptor of the vocabulary, a transducer
that makes exactly one edit (replace, insert), and the acceptor again. The composed machine is never built as a whole.
It is cut into partitions, one per initial state: where two words differ first lies in a window of positions, so
they share all letters before the window and all behind it. A partition holds the words with the same
letters around the same window. Its machine starts where the shared letters end, and accepts what may stand in the window.

Each word is in two partitions per length class (the first and the second half of it); a partition of more
than ``PARTITION_WORDS`` is cut into those of half its window, again and again. At a window of one position only as many
words are left as the alphabet has pairs of letters, so no task meets a group that grows with the vocabulary, and every
pair is found in exactly one partition: that of its first difference.

Words are counted over all documents with a map-side combine. Null texts have no words, an empty table gives an empty
result, very long texts and words are taken whole, repeated rows count each, extra columns are ignored. In a
vocabulary, rows with a null are left out and repeated words are summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, stored, values

#: Words of a partition whose machine is built at once.
PARTITION_WORDS = 4096

#: What a word is, and which letters get lower case.
RUN = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- vocabulary ------------------------------------------------------------------------------


def misspelt(doc_id: Column, word: Column, every: int) -> Column:
    """The word without one letter, if the checksum of the document's id and the word is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    place = (h % F.length(word)).cast("int")
    short = F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
    return F.when(h % every == 0, short).otherwise(word)


def count_words(docs: DataFrame, least_chars: int = 7, least_count: int = 2, misspell_every: int | None = None) -> DataFrame:
    """``word`` and ``n`` over all texts: runs of letters in lower case (A-Z), of at least so many letters and occurrences."""
    # A run of at least so many letters is matched from its beginning to its end, shorter ones are passed over.
    runs = docs.select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{least_chars},}})"), F.lit(0))).alias("run"))
    word = F.translate("run", _UPPER, _LOWER)
    if misspell_every:
        word = misspelt(F.col("doc_id"), word, misspell_every)
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_chars))


# --- machines --------------------------------------------------------------------------------


class Acceptor:
    """Minimal acceptors of word lists, each of words of one length: equal states exist once, also across lists.

    A state is the number of its arcs (letter to state); the one without arcs accepts.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.known: dict[tuple, int] = {}

    def state(self, arcs: dict[str, int]) -> int:
        key = tuple(arcs.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    def add(self, words: list[str]) -> int:
        """The start state for sorted words. States are closed as soon as no later word can reach them."""
        path: list[dict[str, int]] = [{}]
        before = ""
        for word in words:
            common = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                common += 1
            while len(path) > common + 1:
                arcs = path.pop()
                path[-1][before[len(path) - 1]] = self.state(arcs)
            path.extend({} for _ in range(len(word) - common))
            before = word
        while len(path) > 1:
            arcs = path.pop()
            path[-1][before[len(path) - 1]] = self.state(arcs)
        return self.state(path[0])

    def shared(self, one: int, other: int, not_first: str = "") -> list[str]:
        """What both states accept, without words that begin with ``not_first``."""
        found, open_pairs = [], [(one, other, "")]
        while open_pairs:
            one, other, read = open_pairs.pop()
            arcs = self.arcs[one]
            if not arcs:
                found.append(read)
                continue
            others = self.arcs[other]
            for letter, then in arcs.items():
                if letter in others and (read or letter != not_first):
                    open_pairs.append((then, others[letter], read + letter))
        return found


def one_edit_pairs(short: list[str], long: list[str], positions: int) -> Iterator[tuple[str, str]]:
    """Pairs whose first difference is among the first ``positions``: a letter replaced within ``short`` (words of
    one length), or one inserted, which gives a word of ``long`` (one letter more). Both lists are sorted.
    """
    machine = Acceptor()
    begin, begin_long = machine.add(short), machine.add(long) if long else None
    open_states = [(begin, begin_long, "")]
    while open_states:
        state, state_long, read = open_states.pop()
        if len(read) == positions:
            continue
        arcs = list(machine.arcs[state].items())
        for i, (letter, then) in enumerate(arcs):
            for other, then_other in arcs[:i]:
                for rest in machine.shared(then_other, then):
                    yield f"{read}{other}{rest}", f"{read}{letter}{rest}"
        if state_long is not None:
            arcs_long = machine.arcs[state_long]
            for letter, then in arcs_long.items():
                for rest in machine.shared(state, then, letter):
                    yield f"{read}{rest}", f"{read}{letter}{rest}"
        else:
            arcs_long = {}
        for letter, then in arcs:
            open_states.append((then, arcs_long.get(letter), read + letter))


# --- partitions ------------------------------------------------------------------------------

KEY = ("m", "low", "high", "head", "tail")
PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _keyed(rows: DataFrame) -> DataFrame:
    """Words with ``m`` and a window of positions, with the letters that its partition shares."""
    behind = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    return rows.select(
        "word", "n", "m", "low", "high", F.substring("word", F.lit(1), F.col("low")).alias("head"),
        F.substring("word", F.length("word") - behind + 1, behind).alias("tail"))


def _windows(low: Column, high: Column, middle: Column) -> Column:
    """The two halves of a window."""
    return F.explode(F.array(F.struct(low.alias("low"), middle.alias("high")),
                             F.struct(middle.alias("low"), high.alias("high"))))


def _first_partitions(vocabulary: DataFrame) -> DataFrame:
    """``m`` is the length of the shorter word of a pair, so every word stands for its own length and for one less."""
    length = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    middle = F.floor((F.col("m") + 1) / 2).cast("int")
    return _keyed(rows.select("word", "n", "m", _windows(F.lit(0), F.col("m") + 1, middle).alias("w")).select(
        "word", "n", "m", "w.low", "w.high"))


def _narrower(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
    return _keyed(rows.select("word", "n", "m", _windows(F.col("low"), F.col("high"), middle).alias("w")).select(
        "word", "n", "m", "w.low", "w.high"))


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Emitter(PAIRS)
    for batch in batches:
        columns = (values(batch, name) for name in (*KEY, "words"))
        for m, low, high, head, tail, words in zip(*columns):
            counts, short, long = {}, [], []
            for entry in words:
                word, n = entry["word"], entry["n"]
                counts[word] = n
                (short if len(word) == m else long).append(word[low:len(word) - len(tail)])
            short.sort()
            long.sort()
            for a, b in one_edit_pairs(short, long, high - low):
                a, b = f"{head}{a}{tail}", f"{head}{b}{tail}"
                out.add((a, counts[a], b, counts[b]))
            yield from out.ready()
    yield from out.rest()


def near_pairs(vocabulary: DataFrame, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """All pairs of words at one edit, each once: ``word`` and ``near`` with their counts. Words must be distinct."""
    rows, found = _first_partitions(vocabulary), None
    while True:
        sizes = rows.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("size"), F.count_if(F.length("word") == F.col("m")).alias("short"))
        sizes = stored(sizes.where("size > 1 and short > 0"), "spelling-partitions")
        narrow = F.col("high") - F.col("low") == 1
        fits = narrow | (F.col("size") <= partition_words)
        groups = rows.join(sizes.where(fits).select(*KEY), list(KEY)).groupBy(*KEY).agg(
            F.collect_list(F.struct("word", "n")).alias("words"))
        pairs = groups.mapInArrow(_compose, "word string, n long, near string, near_n long")
        found = pairs if found is None else found.unionByName(pairs)
        large = sizes.where(~fits).select(*KEY)
        if large.isEmpty():
            return found
        # At most as many rounds as the longest word can be halved.
        rows = _narrower(rows.join(large, list(KEY)))


# --- variants --------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and the end of its chain of forms. Counts grow tenfold along a chain, so it takes a few doublings."""
    chains = stored(forms.select("word", F.col("form").alias("root")), "spelling-chains")
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(chains.join(further, "root", "left"), "spelling-chains")
        if longer.where("further is not null").isEmpty():
            return chains
        chains = longer.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(vocabulary: DataFrame, times: int = 10, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """Per word its count, near words and form: the near word with the largest count (of equals the first in code-point
    order), if that is at least ``times`` the word's own; ``root`` follows forms to the last one.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    whole = vocabulary.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(whole.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs = near_pairs(words, partition_words)
    both = pairs.select(F.explode(F.array(
        F.struct("word", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    kept = words.join(near, "word", "left")
    with_form = stored(
        kept.withColumn("form", F.when(-F.col("best.n") >= F.lit(times) * F.col("n"), F.col("best.near"))).select(
            "word", "form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("form").isNotNull(), -F.col("best.n")).alias("form_n")),
        "spelling-forms")
    roots = _roots(with_form.where("form is not null"))
    return with_form.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
