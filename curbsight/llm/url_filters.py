"""URL filters with DataFrame functions only: listed rules, and beyond them association rules mined by FP-growth.

A listed rule is a host and the beginning of a path. It fits the host and all its subdomains; of several the longest
decides. The verdicts of listed rules are the labels from which rules for all other URLs are mined: FP-growth counts
combinations of URL tokens, and a combination becomes a rule to block if it is frequent enough among blocked URLs (support)
and few URLs with it are allowed (confidence). A rule that asks for more than another one is left out. Rules are looked up
in an inverted index, each below its rarest token, and verified; a URL that meets none is allowed.

Every part of a URL goes into one of nine slots (``SLOTS``), so a URL has at most nine tokens and 511 combinations,
however long it is. That bounds what FP-growth can find: at most 511 / support combinations, whatever the number of
URLs, and so the size of the index that is broadcast.

Null URLs, and URLs without ``://``, have an empty host and path and no tokens: they are allowed unless a rule says otherwise.
Repeated rows are judged one by one, ids may be null, very long URLs are read whole, an empty table gives an empty
result. All columns of the input are kept; ``host``, ``path``, ``rule`` and ``verdict`` are replaced if it has columns of these names.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import stored

ALLOW, BLOCK = "allow", "block"

#: Where the tokens of a URL come from: scheme, the host's last three labels and what stands before them, first
#: path segment, rest of the path, names in the query, fragment. Digits count as alike behind the host.
SLOTS = ("scheme", "top", "domain", "site", "sub", "section", "page", "query", "fragment")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty for null and where ``://`` is missing."""
    rest = _behind_scheme(url)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits, null if none does. One condition per rule, for short lists."""
    by_length = sorted(rules, key=lambda r: (-len(r.name), r))
    found = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
               F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in by_length
    ]
    return F.coalesce(*found, F.lit(None).cast("struct<rule:string,verdict:string>"))


def url_tokens(url: Column) -> dict[str, Column]:
    """One token per slot, null where the URL has nothing for it."""
    rest = _behind_scheme(url)
    host, path = host_and_path(url)
    labels = F.split(host, r"\.")
    alike = F.regexp_replace(path, "[0-9]+", "0")
    names = F.regexp_replace(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "=[^&]*", "")
    parts = {
        "scheme": F.when(F.instr(url, "://") > 0, F.translate(F.substring_index(url, "://", 1), _UPPER, _LOWER)),
        "top": F.try_element_at(labels, F.lit(-1)),
        "domain": F.try_element_at(labels, F.lit(-2)),
        "site": F.try_element_at(labels, F.lit(-3)),
        "sub": F.array_join(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 3, F.lit(0))), "."),
        "section": F.regexp_extract(alike, "^/([^/]*)", 1),
        "page": F.regexp_extract(alike, "(?s)^/[^/]*(/.*)$", 1),
        "query": F.regexp_replace(names, "[0-9]+", "0"),
        "fragment": F.regexp_replace(F.regexp_extract(rest, "(?s)^[^#]*#(.*)$", 1), "[0-9]+", "0"),
    }
    return {slot: F.when(part != "", F.concat(F.lit(f"{slot}="), part)) for slot, part in parts.items()}


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules to block from ``url`` and ``blocked`` (boolean): sorted tokens, support and confidence.

    A rule has a share of at least ``min_support`` of all labelled URLs that are blocked and have its tokens, and of
    those that have its tokens at least ``min_confidence`` are blocked. Only rules without a shorter one among
    their tokens are kept. Rows with a null in ``blocked`` are no labels.
    """
    label = F.when(F.col("blocked"), "label=block")
    items = labelled.where(F.col("blocked").isNotNull()).select(
        F.array_compact(F.array(*url_tokens(F.col("url")).values(), label)).alias("items"))
    mined = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(items).associationRules
    rules = stored(
        mined.where(F.col("consequent") == F.array(F.lit("label=block"))).select(
            F.array_sort("antecedent").alias("tokens"), "support", "confidence"),
        "url-rules")
    return rules.join(_longer_ones(rules), "tokens", "left_anti")


def _longer_ones(rules: DataFrame) -> DataFrame:
    """Those that have another rule among their tokens: each rule's proper subsets (510 at most), looked up."""
    n = F.size("tokens")
    masks = F.sequence(F.lit(1), F.shiftleft(F.lit(1), 9) - 2)
    subsets = rules.select(F.col("tokens").alias("long"), F.explode(masks).alias("mask")).where(
        "mask < shiftleft(1, size(long)) - 1")
    chosen = F.filter("long", lambda x, i: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)
    return subsets.select("long", chosen.alias("tokens")).join(rules, "tokens", "left_semi").select(
        F.col("long").alias("tokens")).distinct()


def inverted_index(rules: DataFrame) -> DataFrame:
    """For each token the rules of which it is the rarest one (of equals the first in text order)."""
    frequent = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = rules.select("tokens", F.explode("tokens").alias("token")).join(frequent, "token").groupBy("tokens").agg(
        F.min_by("token", F.struct("n", "token")).alias("token"))
    return rarest.groupBy("token").agg(F.collect_list("tokens").alias("rules"))


def blocked_by(index: DataFrame, urls: DataFrame, url: str) -> tuple[DataFrame, Column]:
    """The rows with their tokens, one lookup per slot, and whether all tokens of some rule are there."""
    tokens = {f"_{slot}": token for slot, token in url_tokens(F.col(url)).items()}
    rows = urls.withColumns(tokens)
    hits = []
    for slot in SLOTS:
        posting = F.broadcast(index.select(F.col("token").alias(f"_{slot}"), F.col("rules").alias(f"_{slot}_rules")))
        rows = rows.join(posting, f"_{slot}", "left")
        hits.append(F.col(f"_{slot}_rules"))
    own = F.array_compact(F.array(*(F.col(c) for c in tokens)))
    rows = rows.withColumn("_own", own)
    met = [F.coalesce(F.exists(h, lambda rule: F.size(F.array_except(rule, F.col("_own"))) == 0), F.lit(False))
           for h in hits]
    found = met[0]
    for other in met[1:]:
        found = found | other
    return rows, found


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    *,
    min_support: float = 0.01,
    min_confidence: float = 0.9,
) -> DataFrame:
    """All rows with ``host``, ``path``, the ``rule`` that decides (null if none) and the ``verdict``."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col("_url"))
    listed = pages.select(F.struct(*kept).alias("_row"), F.col(url).alias("_url")).withColumns({
        "_host": host, "_path": path})
    listed = listed.withColumn("_fit", fitting(F.col("_host"), F.col("_path"), rules))
    labelled = listed.where("_fit is not null").select(
        F.col("_url").alias("url"), (F.col("_fit.verdict") == BLOCK).alias("blocked"))
    mined = mine_rules(labelled, min_support, min_confidence)
    rows, blocked = blocked_by(stored(inverted_index(mined), "url-index"), listed, "_url")
    return rows.select(
        "_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", F.when(blocked, BLOCK).otherwise(ALLOW)).alias("verdict"))
