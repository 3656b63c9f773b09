"""URL filter: rules against a plain reading, trees on labelled URLs they have not seen."""

import random

from pyspark.sql import functions as F

from seqprep.llm import url_filter
from tests.conftest import SF_SMALL
from tests.llm.cases import clashing

URLS = [
    None, "", "no scheme", "http://", "http://A.NET/x", "http://a.net", "http://a.net?q=/", "https://xnet/", "http://net/", "http://net./",
    "http://www.Example.net/en/1?x=1#y", "http://example.net/en", "http://example.net/EN/", "ftp://a.b.example.com/de/#t", "http://badexample.com/de/1",
    "http://example.com/fr/de/", "http://x.org/fr/", "http://org/fr/é?p=1", "http://u@x.org/fr/", "http://x.org:80/fr/", "a://b://c.net/d", "http://é.net/%20/" + "x/" * 3000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    ends = [rest.index(c) for c in "/?#" if c in rest]
    host = rest[: min(ends, default=len(rest))]
    tail = rest[len(host) :]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in url_filter.RULES:
        own, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "<p>") for k, u in enumerate(urls)], "page_id long, url string, html string")


def test_rules(spark):
    made = url_filter.judge_urls(pages(spark, URLS + URLS), trees=3).collect()
    assert len(made) == 2 * len(URLS)
    for r in made:
        host, path, rule, verdict = plain(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.learned) and r.learned in ("allow", "block")


def test_longest_rule_wins():
    rules = url_filter.Rules([("block", "a.b/"), ("allow", "b/xy"), ("block", "b/xyz/"), ("allow", "c.a.b/")])
    assert rules.find("a.b", "/xyz/") == ("b/xyz/", "block") and rules.find("a.b", "/xy") == ("a.b/", "block")
    assert rules.find("d.c.a.b", "/") == ("c.a.b/", "allow") and rules.find("", "/") == (None, None)


def test_without_labels_with_one_kind_and_with_nothing(spark):
    df = pages(spark, ["http://a.com/", "http://b.com/x", None])
    assert {r.verdict for r in url_filter.judge_urls(df).collect()} == {"allow"}
    one = pages(spark, ["http://a.net/", "http://b.com/x", None])
    assert {r.verdict for r in url_filter.judge_urls(one).collect()} == {"block"}
    assert url_filter.judge_urls(df.limit(0)).collect() == []


def test_clashing_columns(spark):
    df = clashing(pages(spark, URLS)).selectExpr("*", "1 as host", "2 as verdict", "3 as features", "4 as vector", "5 as bucket_suffix1")
    assert url_filter.judge_urls(df, trees=2).select("page_id", "host", "rule").collect()


def made_urls(n, seed=1):
    """Spam hosts are long, with digits and hyphens; the others are short words."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(k))
    out = []
    for k in range(n):
        if k % 2:
            out.append((f"http://{word(6)}-{word(5)}{rng.randint(100, 9999)}-{word(4)}.example{k % 7}.com/{rng.randint(1, 9**6)}?{word(2)}={rng.randint(1, 999)}&id=3", "block"))
        else:
            out.append((f"https://{word(rng.randint(4, 8))}.example{k % 7}.com/{word(5)}/{word(7)}.html", "allow"))
    return out


def test_trees_tell_unseen_urls(spark):
    known, unseen = made_urls(400, 1), made_urls(400, 2)
    rules = [(verdict, url.split("://")[1].split("/")[0] + "/") for url, verdict in known]
    urls = [u for u, _ in known + unseen]
    made = {r.page_id: r for r in url_filter.judge_urls(pages(spark, urls), rules, trees=8).collect()}
    right = sum(made[400 + k].rule is None and made[400 + k].verdict == verdict for k, (_, verdict) in enumerate(unseen))
    assert right >= 0.95 * len(unseen)


def test_examples_are_bounded_and_distinct(spark):
    rows = url_filter.with_statistics(url_filter.taken_apart(pages(spark, [f"http://h{k % 500}.net/" for k in range(5000)]), url_filter.RULES))
    assert url_filter.examples(rows, 10_000).count() == 500
    assert 20 <= url_filter.examples(rows, 100).count() <= 250


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    made = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    for page_id, url in df.select("page_id", "url").collect():
        host, path, rule, verdict = plain(url)
        r = made.pop(page_id)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or r.learned)
    assert not made


def test_native_statistics_are_bounded(spark):
    df = url_filter.taken_apart(pages(spark, [f"http://h.t{k}/" for k in range(3000)]), url_filter.RULES)
    stats = url_filter.suffix_statistics(df, "suffix1")
    assert stats.count() <= url_filter.BUCKETS
    total = stats.select(F.sum(F.expm1(F.col("figures_suffix1")[0].cast("double")))).first()[0]
    assert abs(total - 3000) < 1
