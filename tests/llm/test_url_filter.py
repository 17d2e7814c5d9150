from __future__ import annotations

import re

from pyspark.sql import functions as F

from pagetrail.llm import url_filter
from pagetrail.llm.queries import QUERIES
from pagetrail.llm.text import table

SF_DIR = "/root/testdata/sf0.01"
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def ruled(url):
    host, path = split(url)
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_equal_brute_force(spark):
    pages = table(spark, SF_DIR, "pages").collect()
    got = {r["page_id"]: r for r in QUERIES["op5_url_filter"](spark, SF_DIR).collect()}
    assert len(got) == len(pages)
    for page in pages:
        host, path, rule, verdict = ruled(page["url"])
        have = got[page["page_id"]]
        assert (have["host"], have["path"], have["rule"]) == (host, path, rule)
        assert have["verdict"] == verdict if verdict else have["verdict"] in ("allow", "block")


def test_hand_written_urls(spark):
    urls = [
        None, "", "no scheme", "http://EXAMPLE.org/en/12", "http://xexample.org/en/12",
        "http://a.example.org?x=/es/", "http://org", "http://org/", "x://y.com/de/#://z",
        "http://u:p@Ä.com:80/fr/a?b", "a://b://c.org/", "http://a.org\n/x",
    ]
    rows = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge_pages(rows).collect()}
    for i, url in enumerate(urls):
        assert tuple(got[i][c] for c in ("host", "path", "rule")) == ruled(url)[:3], url


def propagated(edges, seeds, kind, iterations=10, damping=0.85):
    total = sum(seeds.values())
    start = {n: v / total for n, v in seeds.items() if v} if total else {}
    ranks = dict(start)
    pairs = edges if kind == "trust" else [(b, a, n) for a, b, n in edges]
    out = {}
    for a, _, n in pairs:
        out[a] = out.get(a, 0) + n
    for _ in range(iterations):
        new = {n: (1 - damping) * v for n, v in start.items()}
        for a, b, n in pairs:
            if a in ranks:
                new[b] = new.get(b, 0) + damping * ranks[a] * n / out[a]
        ranks = new
    return ranks


def test_propagation_equals_brute_force(spark):
    edges = [("a", "b", 3), ("b", "c", 1), ("c", "a", 2), ("d", "c", 1), ("e", "d", 5), ("a", "a", 1)]
    seeds = [("a", 4, 0), ("b", 1, 1), ("c", 0, 3)]
    got = url_filter.propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"),
        spark.createDataFrame(seeds, "node string, allowed long, blocked long"),
        iterations=10,
    ).collect()
    for side, column in (("trust", 1), ("distrust", 2)):
        want = propagated(edges, {s[0]: s[column] for s in seeds}, side)
        have = {r["node"]: r[side] for r in got if r[side] > 0}
        assert have.keys() == {n for n, v in want.items() if v > 0}
        assert all(abs(have[n] - want[n]) < 1e-12 for n in have)


def test_hosts_that_link_to_blocked_ones_are_blocked(spark):
    link = lambda *urls: "".join(f'<a href="{u}">x</a>' for u in urls)
    rows = [
        (1, "http://bad.com/de/", link("/de/2")),
        (2, "http://farm.net/", link("http://bad.com/de/", "//BAD.com/de/3")),
        (3, "http://good.org/", link("http://friend.net/x", "mailto:a@b", "rel")),
        (4, "http://friend.net/x", None),
        (5, "http://alone.net/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_pages(pages).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    edges = {tuple(r) for r in url_filter.host_edges(pages).collect()}
    assert edges == {
        ("bad.com", "bad.com", 1), ("farm.net", "bad.com", 2),
        ("good.org", "friend.net", 1), ("good.org", "good.org", 1),
    }


def test_hosts_far_from_blocked_ones_are_blocked(spark):
    """A chain of 30 hosts to a blocked one, and one as long from an allowed host."""
    rows = [(0, "http://bad.com/de/", None), (100, "http://good.org/", '<a href="//t1.net/">')]
    rows += [(i, f"http://h{i}.net/", f'<a href="//h{i - 1}.net/">') for i in range(2, 31)]
    rows += [(1, "http://h1.net/", '<a href="http://bad.com/de/">')]
    rows += [(100 + i, f"http://t{i}.net/", f'<a href="//t{i + 1}.net/">') for i in range(1, 31)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_pages(pages).collect()}
    assert got == {r[0]: "block" if r[0] < 100 else "allow" for r in rows}


def test_steps_go_on_until_values_settle(spark):
    edges = [("a", "b", 3), ("b", "c", 1), ("c", "a", 2), ("d", "c", 1), ("e", "d", 5), ("b", "f", 1)]
    edges += [(f"f{i or ''}", f"f{i + 1}", 1) for i in range(14)]
    seeds = [("a", 4, 0), ("b", 1, 1), ("c", 0, 3)]
    got = url_filter.propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"),
        spark.createDataFrame(seeds, "node string, allowed long, blocked long"),
        iterations=None,
    ).collect()
    for side, column in (("trust", 1), ("distrust", 2)):
        want = propagated(edges, {s[0]: s[column] for s in seeds}, side, iterations=400)
        have = {r["node"]: r[side] for r in got if r[side] > 0}
        assert have.keys() == want.keys()
        assert all(abs(have[n] - want[n]) < 1e-5 * want[n] for n in have)


def test_edges_and_empty(spark):
    rows = [(1, "http://a.org/", "x"), (1, "http://a.org/", "x"), (None, None, None), (2, "", "y" * 10**6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit(1) for c in ("host", "rule", "verdict", "path", "src", "n")})
    got = url_filter.judge_pages(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(str(r["page_id"]) for r in got.collect()) == ["1", "1", "2", "None"]
    assert url_filter.judge_pages(pages.limit(0)).count() == 0
