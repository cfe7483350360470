import random

from tidemark.llm import url_filter as op
from tidemark.llm.queries import URL_RULES


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in op.judge(pages, spark.createDataFrame(rules, op.RULES)).collect())
    assert got == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_equals_brute_force(spark):
    rnd = random.Random(2)
    hosts = ["example.org", "a.b.Example.ORG", "notexample.org", "x.com", "com", "org", "deep.er.x.com", "e.net", ".org", "a..org", "", "user@x.com:80"]
    paths = ["", "/", "/en/1", "/en/100/x", "/en/2", "/es/", "/es", "/fr/a?b=/de/", "/de/#f", "?q=/fr/", "#/fr/", "/de/ü"]
    urls = [rnd.choice(["http://", "https://", "x", "://"]) + rnd.choice(hosts) + rnd.choice(paths) for _ in range(400)]
    check(spark, urls, URL_RULES)


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "http://org/", "http://org/", "http://org", "http://a://org/x", "HTTP://ORG/\nq", "http://x.org/" + "p" * 100_000]
    check(spark, urls, URL_RULES)


def test_precedence_and_empty(spark):
    rules = [("allow", "a.org", "/x/"), ("block", "a.org", "/x/"), ("allow", "b.a.org", "/x/y"), ("block", "b.a.org", "/"), ("allow", None, "/"), ("allow", "", "/")]
    pages = spark.createDataFrame([(1, "http://a.org/x/y"), (2, "http://b.a.org/x/yz"), (3, "http://b.a.org/q")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in op.judge(pages, spark.createDataFrame(rules, op.RULES)).collect()}
    assert got == {1: ("a.org/x/", "block"), 2: ("b.a.org/x/y", "allow"), 3: ("b.a.org/", "block")}
    assert {r.verdict for r in op.judge(pages, spark.createDataFrame([], op.RULES)).collect()} == {"allow"}
    assert op.judge(pages.limit(0), spark.createDataFrame(rules, op.RULES)).count() == 0


def test_very_long_hosts(spark):
    """Only suffixes that some rule can have are made: a host of 16,000 labels costs no more than its length."""
    import time

    long = ".".join(["a"] * 16_000)
    began = time.monotonic()
    check(spark, [f"http://{long}.example.org/en/1x", f"http://{long}/", "http://" + "." * 16_000 + "com/de/"], URL_RULES)
    assert time.monotonic() - began < 30
