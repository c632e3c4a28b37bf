from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES

UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, rest = rest[:cut].translate(UP), rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
    return host, rest[:end]


def stated(host, path):
    best = (None, None)
    for verdict, rule in URL_RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail) and len(rule) > len(best[0] or ""):
            best = rule, verdict
    return best


def tokens(host, path):
    labels = [x for x in host.split(".")[::-1] if x]
    segments = [x for x in path.translate(UP).split("/") if x]
    return {f"h{i}:{x}" for i, x in enumerate(labels)} | {f"p{i}:{x}" for i, x in enumerate(segments)}


def brute(rows):
    """Rules from all subsets of the tokens, and the verdicts that follow."""
    split = [(i, *parts(u)) for i, u in rows]
    labelled = [(tokens(h, p), stated(h, p)[1] == "block") for _, h, p in split]
    least = max(2, int(urls.SUPPORT * len(rows)))
    counts = {}
    for t, bad in labelled:
        if bad:
            for x in t:
                counts[x] = counts.get(x, 0) + 1
    useful = {x for x, c in counts.items() if c >= least}
    all_, blocked = {}, {}
    for t, bad in labelled:
        t = sorted(t & useful)
        for n in range(1, len(t) + 1):
            for c in combinations(t, n):
                all_[c] = all_.get(c, 0) + 1
                blocked[c] = blocked.get(c, 0) + bad
    rules = {c: blocked[c] / all_[c] for c in all_ if blocked[c] >= least and blocked[c] / all_[c] >= urls.CONFIDENCE}
    out = []
    for i, h, p in split:
        rule, verdict = stated(h, p)
        hits = [conf for c, conf in rules.items() if set(c) <= tokens(h, p)]
        out.append((i, h, p, rule, verdict or ("block" if hits else "allow")))
    return out


def compare(frame):
    rows = [(r["page_id"], r["url"]) for r in frame.collect()]
    got = [tuple(r)[:5] for r in urls.judge(frame, URL_RULES).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_pages(spark, size):
    compare(spark.read.parquet(f"/root/testdata/{size}/pages.parquet").select("page_id", "url", F.lit(1).alias("host")))


def test_awkward_urls_and_mined_rules(spark):
    rows = [(i, f"https://a{i % 3}.example.net/es/{i}") for i in range(30)] + [
        (100, "https://b.example.net/es"), (101, "HTTP://WWW.Example.COM/en/x?q=/y"), (102, "x://example.com/en/"),
        (103, "https://sub.example.com"), (104, None), (105, ""), (106, "no scheme/net/es/"), (107, "a://b://net/es/"),
        (108, "http://net/fr/"), (109, "http://evilnet/fr/"), (110, "http://x.net/ES/\nq"), (111, "http://example.com/EN/"),
        (112, "://com/"), (113, "http://x.com#/en/"), (114, "http:///path"), (None, "http://x.org/"), (103, "https://sub.example.com"),
        (115, "http://" + "a." * 400 + "net/fr/" + "b/" * 400)]
    compare(spark.createDataFrame(rows, "page_id bigint, url string"))
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string"), URL_RULES).collect()}
    assert verdicts[100] == "block"  # no rule fits, but all pages like it are blocked


def test_rare_combinations_of_common_tokens_are_no_rules(spark):
    """Two tokens common among blocked pages that meet once: that one page is no rule, however sure it looks."""
    rows = [(i, f"https://a.net/es/x/{i}") for i in range(10)] + [(100 + i, f"https://b.org/y/{i}") for i in range(3000)]
    rows += [(5000 + i, f"https://a.org/q/x/{i}") for i in range(9)] + [(6000 + i, f"https://c.net/fr/y/{i}") for i in range(12)]
    rows += [(7000, "https://c.net/es/x"), (7001, "https://c.org/es/x"), (7002, "https://c.net/z/x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    compare(pages)
    said = urls.judge(pages, URL_RULES)
    labelled = said.select(urls.tokens_of(F.col("host"), F.col("path")).alias("tokens"),
                           F.coalesce(F.col("rule").isNotNull() & (F.col("verdict") == "block"), F.lit(False)).alias("blocked"))
    n, mined = len(rows), urls.mine(labelled).collect()
    tables = [(tokens(*parts(u)), stated(*parts(u))[1] == "block") for _, u in rows]
    assert mined
    for r in mined:
        hits = [bad for t, bad in tables if set(r["tokens"]) <= t]
        assert sum(hits) >= int(urls.SUPPORT * n) and r["support"] == pytest.approx(sum(hits) / n)
        assert r["confidence"] == pytest.approx(sum(hits) / len(hits))


def test_tokens_that_always_stand_together_count_as_one(spark):
    deep = "/".join(f"d{i}" for i in range(30))
    rows = [(i, f"https://a.net/es/{deep}") for i in range(20)] + [(100 + i, f"https://b{i}.com/") for i in range(50)] + [
        (200, f"https://x.org/es/{deep}")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(pages, URL_RULES).collect()}
    assert verdicts[200] == "block" and verdicts[100] == "allow"


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0
