"""Listed rules against plain string code, mined rules against counting."""

import random
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tickengine.llm import url_rules as u

LISTED = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for rule, says in LISTED:
        own, _, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = rule, says
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q#f", "https://example.net", "x://net/",
    "http://planet/", "http://example.com/de", "http://m.example.com/de/1", "http://example.org/fr/://net/",
    "http://example.net?/en/", "http://ÄB.net/\n", "http://example.net/en/#://", "ftp://user@h.net:80/a",
]


def test_listed_rules(spark):
    pages = spark.createDataFrame(
        [(i, url, "z") for i, url in enumerate(URLS)] + [(None, URLS[4], "z"), (1, URLS[1], "z")],
        "page_id long, url string, tokens string",
    )
    none = spark.createDataFrame([], u.RULE_SCHEMA)
    found = u.judge(pages, none, u.BLOCK, u.ALLOW).collect()
    assert len(found) == len(URLS) + 2
    expected = {i: plain(url) for i, url in enumerate(URLS)} | {None: plain(URLS[4])}
    for row in found:
        host, path, rule, says = expected[row["page_id"]]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (says or "allow")


def mined(rows, min_count, confidence, most):
    """All rules by counting, without those that a shorter one implies."""
    rules = {}
    tokens = {t for own, _ in rows for t in own}
    for n in range(1, most + 1):
        for items in combinations(sorted(tokens), n):
            hit = [bad for own, bad in rows if set(items) <= own]
            if sum(hit) >= min_count and sum(hit) / len(hit) >= confidence:
                if not any(set(r) < set(items) and c >= sum(hit) / len(hit) for r, c in rules.items()):
                    rules[items] = sum(hit) / len(hit)
    return rules


def test_rules_are_mined_and_matched(spark):
    rows = [(f"http://{h}.example.com/{p}/{i}", bad) for i, (h, p, bad) in enumerate(
        [("casino", "win", True)] * 8 + [("casino", "news", False)] * 6 + [("blog", "win", False)] * 6
        + [("blog", "spam", True)] * 7 + [("x", "y", False)] * 4 + [("x", "y", None)] * 3
    )]
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    parts = spark.createDataFrame(rows, "url string, bad boolean").select(
        u.tokens(F.col("url")).alias("t"), "bad"
    )
    known = [(set(r["t"]), r["bad"]) for r in parts.collect() if r["bad"] is not None]
    found = u.learn(frame, min_support=0.0, min_count=5, min_confidence=0.7, max_tokens=3)
    got = {tuple(r["antecedent"]): round(r["confidence"], 6) for r in found.collect()}
    assert got == {k: round(v, 6) for k, v in mined(known, 5, 0.7, 3).items()}
    assert any(set(r) == {"host:casino", "path:win"} for r in got)
    pages = spark.createDataFrame(
        [(1, "http://casino.net/win"), (2, "http://casino.org/x"), (3, None), (4, "http://a.b/spam")],
        "page_id long, url string",
    )
    says = {r["page_id"]: r["verdict"] for r in u.judge(pages, found).collect()}
    assert says == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def test_rules_of_five_tokens_are_kept(spark):
    own = ["a", "b", "c", "d", "e"]
    rows = [("http://h/" + "/".join(own), True)] * 30
    rows += [("http://h/" + "/".join(t for t in own if t != gone), False) for gone in own for _ in range(30)]
    found = u.learn(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert [(r["antecedent"], r["confidence"]) for r in found] == [([f"path:{t}" for t in own], 1.0)]


@pytest.mark.parametrize("others", [100, 30_000])
def test_support_is_alike_at_every_size(spark, others):
    bad = [("http://worse.biz/x", True)] * 20 + [("http://few.org/y", True)] * 19
    good = spark.range(others).selectExpr("concat('http://fine.net/p', id % 50) url", "false bad")
    found = u.learn(spark.createDataFrame(bad, "url string, bad boolean").union(good)).collect()
    assert {tuple(r["antecedent"]) for r in found} == {("host:biz",), ("host:worse",), ("path:x",)}


def test_thirty_tokens_in_common(spark):
    """All subsets of them are frequent; they are one item, and a rule for each of them."""
    path = "/".join(chr(97 + i // 26) + chr(97 + i % 26) for i in range(30))
    bad = [(f"http://bad.org/{path}?n={i}", True) for i in range(40)]
    good = [(f"http://good.org/{path[:8]}/x{i % 7}", False) for i in range(60)]
    began = time.monotonic()
    rules = u.learn(spark.createDataFrame(bad + good, "url string, bad boolean"))
    found = {tuple(r["antecedent"]): r["confidence"] for r in rules.collect()}
    assert time.monotonic() - began < 60
    assert ("host:bad",) in found and ("path:bd",) in found and set(found.values()) == {1.0}
    assert ("path:aa",) not in found and len(found) == 29  # the host, 27 tokens of the path, the query
    pages = spark.createDataFrame([(1, f"http://x.net/{path}"), (2, "http://bad.com/"), (3, "http://y.z/aa")],
                                  "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in u.judge(pages, rules).collect()} == {1: "block", 2: "block", 3: "allow"}


def test_other_urls_are_not_mined(spark):
    """Combinations of good urls only, here all subsets of 24 tokens, cost nothing."""
    pick = random.Random(4)
    names = [chr(97 + i) * 2 for i in range(24)]
    good = [("http://good.org/" + "/".join(pick.sample(names, 22)), False) for _ in range(400)]
    bad = [(f"http://bad.org/aa/zz/{i}", True) for i in range(30)]
    began = time.monotonic()
    rules = u.learn(spark.createDataFrame(good + bad, "url string, bad boolean")).collect()
    assert time.monotonic() - began < 60
    assert {tuple(r["antecedent"]) for r in rules} == {("host:bad",), ("path:zz",), ("path:#",)}
    assert {(r["confidence"], r["support"]) for r in rules} == {(1.0, 30 / 430)}


def test_too_few_bad_urls_give_no_rule(spark):
    rows = [(f"http://bad.org/{i}", True) for i in range(19)] + [("http://good.org/", False)] * 5
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    assert u.learn(frame).count() == 0 and u.learn(frame, min_count=19).count() > 0


def test_empty_tables(spark):
    labelled = spark.createDataFrame([], "url string, bad boolean")
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = u.learn(labelled)
    assert rules.count() == 0
    assert u.judge(pages, rules, u.BLOCK, u.ALLOW).count() == 0


def test_query(spark, sf_dir, rows_of):
    found = {r["page_id"]: r for r in u.query(spark, sf_dir).collect()}
    for page, url in rows_of("pages", "page_id, url"):
        host, path, rule, says = plain(url)
        row = found.pop(page)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert says is None or row["verdict"] == says
    assert not found


@pytest.mark.parametrize("url, tokens", [
    ("http://www.a-b.example.com/en/12/x_y.html?p=2&q#f",
     ["host:a", "host:b", "host:com", "host:example", "host:www", "path:#", "path:en", "path:html",
      "path:x", "path:y", "query:p=#", "query:q"]),
    ("nothing", []),
])
def test_tokens(spark, url, tokens):
    row = spark.createDataFrame([(url,)], "url string").select(u.tokens(F.col("url")).alias("t")).first()
    assert row["t"] == tokens
