"""Rules, aliases and precedence on small tables; components on hard graphs."""

from __future__ import annotations

import random

import pytest

from obsledger.llm.graph import connected_components
from obsledger.llm.url_filters import judge_urls

SCHEMA = "page_id bigint, url string, html string, host int, node string"
RULES = [("allow", "org/"), ("block", "bad.org/x/"), ("block", "com/de/"), ("allow", "com/fr/")]


def canonical(url):
    return f'<html><LINK data-a="1" rel="canonical" href="{url}"></html>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


def test_verdicts(spark):
    pages = [
        (1, "https://m.Bad.ORG/x/1?q#f", None),  # the longest rule
        (2, "http://notbad.org/x/1", ""),  # org/ only: hosts end at a dot
        (3, "http://a.com/de/1", None),
        (4, "http://b.net/1", canonical("http://www.a.com/de/1/?utm_source=z")),  # alias of a blocked page
        (5, "http://c.net/2", refresh("//b.net/1")),  # two steps away
        (6, "http://d.net/", canonical("/3")),
        (7, "http://d.net/3", canonical("http://a.com/fr/9")),  # class with an allowed and a blocked member
        (8, "http://a.com/fr/9", refresh("http://a.com/de/7")),
        (9, "http://a.com/de/7", None),
        (10, None, None),
        (11, "no scheme", ""),
        (12, "http://e.org", None),  # an empty path begins with no rule's path
        (3, "http://a.com/de/1", None),
        (13, "", None),
    ]
    got = judge_urls(spark.createDataFrame([(*p, 1, "x") for p in pages], SCHEMA), RULES).collect()
    rows = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got)
    assert [r[:3] + r[4:] for r in rows] == [
        (1, "m.bad.org", "/x/1", "block"),
        (2, "notbad.org", "/x/1", "allow"),
        (3, "a.com", "/de/1", "block"),
        (3, "a.com", "/de/1", "block"),
        (4, "b.net", "/1", "block"),
        (5, "c.net", "/2", "block"),
        (6, "d.net", "/", "allow"),
        (7, "d.net", "/3", "allow"),
        (8, "a.com", "/fr/9", "allow"),
        (9, "a.com", "/de/7", "block"),
        (10, "", "", "allow"),
        (11, "", "", "allow"),
        (12, "e.org", "", "allow"),
        (13, "", "", "allow"),
    ]
    assert [r[3] for r in rows][:4] == ["bad.org/x/", "org/", "com/de/", "com/de/"]


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), RULES).count() == 0


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)], [(i, i) for i in range(3)], None])
def test_components(spark, edges):
    if edges is None:
        r = random.Random(4)
        edges = [(r.randrange(90), r.randrange(90)) for _ in range(70)] + [(None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
