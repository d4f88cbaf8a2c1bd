"""URL filter: parts and rules against plain Python, the model on hosts it has not seen."""

import re

import pyarrow.parquet as pq

from murmur.llm import urls
from murmur.llm.queries import QUERIES, URL_RULES
from tests.conftest import SF_SMALL


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = (None, None)
    for rule, says in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, says)
    return host, path, *best


def check(rows, pages):
    want, got = {}, {}
    for page, url in pages:
        want.setdefault(page, []).append(brute(url))
    for r in rows:
        got.setdefault(r["page_id"], []).append(r)
    assert set(got) == set(want)
    for page, lists in want.items():
        for r, (host, path, rule, says) in zip(sorted(got[page], key=lambda r: r["host"]), sorted(lists, key=lambda x: x[0])):
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert r["verdict"] == says if says else r["verdict"] in ("allow", "block")
            assert (r["score"] is None) == (says is not None)


def test_whole_table(spark):
    t = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pydict()
    rows = urls.judge(spark.read.parquet(f"{SF_SMALL}/pages.parquet"), URL_RULES).collect()
    check(rows, list(zip(t["page_id"], t["url"])))


def test_edges(spark):
    pages = [(1, None), (2, ""), (3, "no scheme example.org/es/1"), (4, "HTTP://A.Example.ORG/es/x?y#z"), (5, "x://example.org"),
             (6, "http://example.org/en/1"), (7, "http://example.org/en/2"), (8, "http://myexample.org/es/"), (9, "a://b://example.org/es/"),
             (10, "http://É.com/fr/"), (11, "http://z.com/de/"), (11, "http://z.com/de/"), (12, "http://z.com\n/fr/\nq"), (None, "http://z.com?/fr/"),
             (13, "http://h.org/" + "x" * 200_000), (14, "://org/")]
    df = spark.createDataFrame([(*p, "b") for p in pages], "page_id long, url string, verdict string")
    check(urls.judge(df, URL_RULES).collect(), pages)
    assert urls.judge(df.limit(0), URL_RULES).collect() == []
    model = urls.fit(urls.LABELLED)
    assert model.score("", "") < 0.5 and urls.fit([]).score("a", "/b") < 0.5


def test_model_on_unseen_hosts():
    model = urls.fit(urls.LABELLED)
    said = {h: model.score(h, "/en/123") >= 0.5 for h in (
        "m.ads-track.example.com", "free-bets.example.net", "cheap-pills.example.net", "spam-farm.example.net",
        "blog.casino-win.example.net", "adult-x.example.com")}
    assert all(said.values()), said
    t = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pydict()
    bad = re.compile("ads-|bets|pills|spam|casino|adult")
    plain = [urls.split(u) for u in t["url"] if not bad.search(u)]
    assert sum(model.score(h, p) >= 0.5 for h, p in plain) <= 0.01 * len(plain)


def test_split_agrees_with_sql(spark):
    raw = [None, "", "a://B/c?d", "a://b#c/d", "a:/b", "x y://Q/w\n/e", "a://b/c#d?e"]
    df = spark.createDataFrame([(u,) for u in raw], "url string")
    got = df.select(urls.host_of(df.url).alias("h"), urls.path_of(df.url).alias("p")).collect()
    assert [tuple(r) for r in got] == [urls.split(u) for u in raw]


def test_registered_rules_are_those_of_the_contract(spark, scratch):
    said = {("x://org/", "org/"): "allow", ("x://a.org/q", "org/"): "allow", ("x://example.org/es/1", "example.org/es/"): "block",
            ("x://m.example.org/en/12", "example.org/en/1"): "block", ("x://example.org/en/2", "org/"): "allow",
            ("x://b.com/fr/", "com/fr/"): "allow", ("x://b.com/de/", "com/de/"): "block"}
    spark.createDataFrame([(k, url) for k, (url, _) in enumerate(said)], "page_id long, url string").write.parquet(f"{scratch}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in QUERIES["op5_url_filter"](spark, scratch).collect()}
    assert got == {k: (rule, v) for k, ((_, rule), v) in enumerate(said.items())}
