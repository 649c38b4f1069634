from __future__ import annotations

import random
import re

from armlens.llm.queries import URL_RULES
from armlens.llm.urls import Rule, filter_urls

CLASHING = "page_id bigint, url string, host string, path string, rule string, verdict string, canonical string"


def expected(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for rule in rules:
        glob = ".*".join(map(re.escape, rule.path.split("*")))
        if (host == rule.host or host.endswith("." + rule.host)) and re.match(glob, path, re.S):
            if best is None or (-len(rule.name), rule.name) < (-len(best.name), best.name):
                best = rule
    return host, path, best and best.name, best.verdict if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, *"?????") for i, u in enumerate(urls)], CLASHING)
    out = {r["page_id"]: r for r in filter_urls(pages, rules).collect()}
    for i, url in enumerate(urls):
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == expected(url, rules), url


def test_given_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://Com/", "http://com", "https://a.com?x/", "http://example.com/en/",
            "http://www.Example.com/en/a?b", "http://xwww.example.com/en/a", "http://badexample.com/en/", "http://x.net/es/1",
            "http://net/fr/", "http://x.net/de/", "http://x.net#/es/", "a://b://c.com/", "http://É.com/É", "http://a.com/" + "y" * 5_000]
    check(spark, urls, URL_RULES)


def test_random_rules_over_several_words(spark):
    rng = random.Random(8)
    part = lambda: "".join(rng.choice("ab.") for _ in range(rng.randint(1, 5)))
    rules = [Rule(part(), "/" + "".join(rng.choice("ab/*") for _ in range(rng.randint(0, 5))), rng.choice(("allow", "block")))
             for _ in range(60)]
    urls = [f"http://{part()}{part()}/{'/'.join(part() for _ in range(3))}" for _ in range(300)]
    check(spark, urls, rules)


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).collect() == []
