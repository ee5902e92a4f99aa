"""Secret scan with a trigram index, with DataFrame functions only.

From each rule's regular expression follows a Boolean query over trigrams that every match must contain. The index
has the postings of those trigrams, one folder each: which texts (in lower case) hold it. Postings are intersected per text,
the rules' queries are evaluated on them, and only candidates are verified with the expression itself. A rule whose
expression has no mandatory trigram is verified on every text.

Matches of a rule are leftmost and don't overlap; positions count code points, ends are exclusive. Null texts
count as empty. Repeated rows are scanned one by one, ids may be null, extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re._constants as ops
import re._parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """``shortest`` is the least length of ``group`` (0: the whole match); shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 0


# What a secret looks like. The first three are always reported.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: Sets of strings that stand for a part of an expression are followed up to this size.
MOST_STRINGS = 64
#: Spans of a text that are collected at once.
BLOCK_SPANS = 256
#: A class of more characters is unknown content.
MOST_CHARACTERS = 8


# --- trigram queries -------------------------------------------------------------------------

#: Alternatives, each a set of trigrams that all have to occur; None: no condition.
Query = frozenset | None


def _and(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _least(frozenset(x | y for x in a for y in b))


def _or(parts: list[Query]) -> Query:
    return None if any(p is None for p in parts) else _least(frozenset().union(*parts))


def _least(query: frozenset) -> frozenset:
    """Without alternatives that ask for more than another one."""
    return frozenset(x for x in query if not any(y < x for y in query))


def _of_strings(strings: set[str]) -> Query:
    """Some of the strings occurs."""
    if any(len(s) < 3 for s in strings):
        return None
    return _least(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _class_members(items: list) -> set[str] | None:
    members: set[str] = set()
    for op, value in items:
        if op is ops.LITERAL:
            members.add(chr(value).lower())
        elif op is ops.RANGE and value[1] - value[0] <= MOST_CHARACTERS:
            members |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return members


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The strings that an expression stands for, if they are few, and the query that all its matches fulfil."""
    query: Query = None
    run: set[str] | None = {""}  # what the text may be since the last part of unknown content
    whole = True

    def close() -> None:
        nonlocal query, run, whole
        query, run, whole = _and(query, _of_strings(run)), {""}, False

    def append(strings: set[str]) -> None:
        nonlocal run
        joined = {a + b for a, b in itertools.product(run, strings)}
        if len(joined) > MOST_STRINGS:
            close()
            joined = strings if len(strings) <= MOST_STRINGS else {""}
        run = joined

    for op, value in tree:
        if op is ops.LITERAL:
            append({chr(value).lower()})
        elif op is ops.IN and (members := _class_members(value)) and len(members) <= MOST_CHARACTERS:
            append(members)
        elif op is ops.AT:
            continue
        elif op is ops.SUBPATTERN:
            strings, inner = _walk(value[3])
            if strings is None:
                close()
                query = _and(query, inner)
            else:
                append(strings)
        elif op is ops.BRANCH:
            branches = [_walk(b) for b in value[1]]
            if any(strings is None for strings, _ in branches):
                close()
                query = _and(query, _or([q if s is None else _of_strings(s) for s, q in branches]))
            else:
                append(set().union(*(s for s, _ in branches)))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            least, most, inner = value
            strings, needed = _walk(inner)
            if strings is not None and (least, most) == (0, 1):
                append(strings | {""})
            elif least == 0:
                close()
            elif strings is None:
                close()
                query = _and(query, needed)
            else:
                append(strings)
                close()
        else:
            close()
    if whole:
        return run, _of_strings(run)
    return None, _and(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams (lower case) of which every match of the expression contains one set."""
    return _walk(re._parser.parse(pattern))[1]


# --- on Spark --------------------------------------------------------------------------------


def build_index(texts: DataFrame, trigrams: list[str], path: str) -> None:
    """Postings (trigram, row_key) of the given trigrams over all texts, one folder per trigram."""
    held = F.transform(F.array(F.lower("text")),
                       lambda low: F.filter(F.lit(trigrams), lambda t: F.contains(low, t)))[0]
    texts.select("row_key", F.explode(held).alias("trigram")).write.partitionBy("trigram").parquet(path)


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """row_key and the kinds of the rules whose query the text's postings fulfil."""
    by_text = index.groupBy("row_key").agg(F.collect_set("trigram").alias("held"))

    def fulfilled(query: frozenset) -> Column:
        ways = [F.size(F.array_except(F.lit(sorted(way)), F.col("held"))) == 0 for way in sorted(map(sorted, query))]
        out = ways[0]
        for way in ways[1:]:
            out = out | way
        return out

    kinds = [F.when(fulfilled(q), F.lit(kind)) for kind, q in queries.items()]
    return by_text.select("row_key", F.array_compact(F.array(*kinds)).alias("kinds")).where("size(kinds) > 0")


def matches(rule: Rule, order: int) -> Column:
    """The rule's spans in ``text`` as structs (start, order, end, kind).

    The text between matches and the matches themselves add up to the positions.
    """
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    between = F.split("text", rule.pattern, -1)
    steps = F.zip_with(F.slice(between, 1, F.greatest(F.size(between) - 1, F.lit(0))), F.arrays_zip(
        found.alias("all"), judged.alias("judged")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["all"]).alias("size"),
                                F.length(m["judged"]).alias("judged")))
    shape = "struct<at:int,out:array<struct<start:int,order:int,end:int,kind:string>>>"

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + m["size"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"))
        out = F.when(m["judged"] >= rule.shortest, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out")).cast(shape)

    start = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(shape)
    blocks = "struct<at:int,out:array<array<struct<start:int,order:int,end:int,kind:string>>>>"

    def shifted(state: Column, block: Column) -> Column:
        """The spans of a block moved behind those of the blocks before it."""
        moved = F.transform(block["out"], lambda x: F.struct(
            (x["start"] + state["at"]).alias("start"), x["order"].alias("order"), (x["end"] + state["at"]).alias("end"),
            x["kind"].alias("kind")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out")).cast(blocks)

    def joined(all_steps: Column) -> Column:
        # Spans are collected in blocks, because every one that is added copies those before it.
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / BLOCK_SPANS).cast("int"))
        parts = F.transform(numbers, lambda n: F.aggregate(F.slice(all_steps, n * BLOCK_SPANS + 1, BLOCK_SPANS), start, step))
        first = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(blocks)
        return F.when(F.size(all_steps) > 0, F.flatten(F.aggregate(parts, first, shifted)["out"])).otherwise(start["out"])

    return F.transform(F.array(steps), joined)[0]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, text and its spans, in order of start and then of the rules."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("row_key", F.xxhash64("doc_id", "text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    trigrams = sorted({t for q in queries.values() for way in q for t in way})
    path = scratch_dir(spark, "trigram-index")
    build_index(texts, trigrams, path)
    index = spark.read.schema("row_key long, trigram string").parquet(path)
    flagged = texts.join(candidates(index, queries), "row_key", "left")
    nothing = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    spans = [matches(r, i) if r.kind not in queries
             else F.when(F.array_contains("kinds", r.kind), matches(r, i)).otherwise(nothing)
             for i, r in enumerate(rules)]
    return flagged.select("doc_id", "text", F.sort_array(F.concat(*spans)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(scanned: DataFrame) -> DataFrame:
    """The texts with every span replaced by its kind in brackets; of overlapping spans the first one counts."""
    shape = "struct<at:int,out:string>"

    def step(state: Column, s: Column) -> Column:
        kept = F.substr("text", state["at"] + 1, s["start"] - state["at"])
        more = F.struct(s["end"].alias("at"),
                        F.concat(state["out"], kept, F.lit("["), s["kind"], F.lit("]")).alias("out")).cast(shape)
        return F.when(s["start"] >= state["at"], more).otherwise(state)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(shape)
    done = F.aggregate("spans", start, step, lambda state: F.concat(
        state["out"], F.substr("text", state["at"] + 1, F.length("text"))))
    return scanned.withColumn("text", done)
