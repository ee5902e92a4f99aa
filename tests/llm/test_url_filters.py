"""URL filters: listed rules by hand, mined rules against all combinations counted plainly."""

from __future__ import annotations

import itertools
import math
import random
import re

from pyspark.sql import functions as F

from curbsight.llm import url_filters
from curbsight.llm.registry import URL_RULES


def pages(spark, urls: list):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def judged(spark, urls: list, rules=URL_RULES, **options) -> dict:
    rows = url_filters.judge_urls(pages(spark, urls), rules, **options).collect()
    assert len(rows) == len(urls)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


def test_hosts_paths_and_listed_rules(spark):
    cases = [
        ("http://A.example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/19", "example.org", "/en/19", "example.org/en/1", "block"),
        ("https://badexample.org/en/19", "badexample.org", "/en/19", "org/", "allow"),
        ("http://x.org?q=/es/", "x.org", "", None, "allow"),
        ("http://x.com/fr/#a?b", "x.com", "/fr/", "com/fr/", "allow"),
        ("http://x.com/de/?u=http://y.org/", "x.com", "/de/", "com/de/", "block"),
        ("no address", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("://com/de/", "com", "/de/", "com/de/", "block"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
        ("http://É.COM/fr/é", "É.com", "/fr/é", "com/fr/", "allow"),
    ]
    found = judged(spark, [c[0] for c in cases], min_support=1.0)
    assert [found[i] for i in range(len(cases))] == [c[1:] for c in cases]


def tokens_of(url: str | None) -> frozenset:
    """The slots, written again in plain Python."""
    if url is None or "://" not in url:
        return frozenset()
    scheme, rest = url.split("://", 1)
    ascii_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = re.match(r"[^/?#]*", rest)[0]
    behind = rest[len(host):]
    host = host.translate(ascii_lower).split(".")
    before, _, fragment = behind.partition("#")
    path, _, query = before.partition("?")
    zero = re.compile("[0-9]+")
    path = zero.sub("0", path)
    cut = path.find("/", 1) if path.startswith("/") else -1
    parts = {
        "scheme": scheme.translate(ascii_lower), "top": host[-1], "domain": host[-2] if len(host) > 1 else "",
        "site": host[-3] if len(host) > 2 else "", "sub": ".".join(host[:-3]),
        "section": (path[1:cut] if cut > 0 else path[1:]) if path.startswith("/") else "", "page": path[cut:] if cut > 0 else "",
        "query": zero.sub("0", re.sub("=[^&]*", "", query)), "fragment": zero.sub("0", fragment),
    }
    return frozenset(f"{k}={v}" for k, v in parts.items() if v)


def rules_of(labelled: list, support: float, confidence: float) -> set:
    counts: dict = {}
    for url, blocked in labelled:
        own = sorted(tokens_of(url))
        for size in range(1, len(own) + 1):
            for combination in itertools.combinations(own, size):
                n = counts.setdefault(combination, [0, 0])
                n[blocked] += 1
    least = math.ceil(support * len(labelled))
    rules = {k for k, (no, yes) in counts.items() if yes >= max(least, 1) and yes / (no + yes) >= confidence}
    return {r for r in rules if not any(set(x) < set(r) for x in rules)}


def made_up(seed: int, n: int) -> list:
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        host = draw.choice(["", "www.", "a.b."]) + draw.choice(["x", "pills", "bets"]) + draw.choice([".ex", ""])
        host += "." + draw.choice(["com", "org", "net"])
        path = draw.choice(["", "/", f"/{draw.choice(['de', 'fr', 'en'])}/{draw.randint(1, 99)}.html"])
        out.append(f"{draw.choice(['http', 'HTTPS'])}://{host}{path}{draw.choice(['', '?p=1&r=x', '?p=22&r'])}"
                   f"{draw.choice(['', '#top'])}")
    return out


def test_mined_rules_are_all_and_the_shortest(spark):
    urls = made_up(1, 300) + [None, "no address"]
    labelled = [(u, ("pills" in (u or "")) ^ (i % 17 == 0) or "de/" in (u or "")) for i, u in enumerate(urls)]
    frame = spark.createDataFrame(labelled + [("http://a.com/", None)], "url string, blocked boolean")
    for support, confidence in ((0.02, 0.9), (0.05, 0.6), (0.1, 1.0)):
        mined = url_filters.mine_rules(frame, support, confidence).collect()
        assert {tuple(r["tokens"]) for r in mined} == rules_of(labelled, support, confidence)
        assert all(r["support"] >= support and r["confidence"] >= confidence for r in mined)


def test_other_urls_are_judged_by_the_mined_rules(spark):
    urls = made_up(2, 500)
    found = judged(spark, urls, min_support=0.02, min_confidence=0.8)
    labelled = [(urls[i], v[3] == "block") for i, v in found.items() if v[2] is not None]
    rules = rules_of(labelled, 0.02, 0.8)
    assert rules
    for i, (_, _, rule, verdict) in found.items():
        if rule is None:
            assert (verdict == "block") == any(set(r) <= tokens_of(urls[i]) for r in rules), urls[i]
    assert {v[3] for v in found.values() if v[2] is None} == {"allow", "block"}


def test_odd_tables(spark):
    assert url_filters.judge_urls(pages(spark, []), URL_RULES).count() == 0
    rows = [(1, None, "h", 1.0, "r"), (1, None, "h", 1.0, "r"), (None, "http://x.org/" + "a/" * 200_000, "h", None, "r"),
            (2, "http://x.org/" + "?q" * 9, None, 2.0, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, verdict double, _row string")
    out = url_filters.judge_urls(frame, URL_RULES)
    assert out.columns == ["page_id", "url", "_row", "host", "path", "rule", "verdict"]
    found = out.orderBy(F.col("page_id").asc_nulls_first(), "url").collect()
    assert [(r["page_id"], r["host"], r["rule"], r["verdict"], r["_row"]) for r in found] == [
        (None, "x.org", "org/", "allow", "r"), (1, "", None, "allow", "r"), (1, "", None, "allow", "r"),
        (2, "x.org", "org/", "allow", None)]
    assert len(found[0]["path"]) == 400_001


def test_no_python_and_no_shuffle_of_the_pages(spark):
    plan = url_filters.judge_urls(pages(spark, made_up(3, 50)), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
