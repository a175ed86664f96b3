"""Revisit resolution against a plain scan, with slices of a few rows."""

from __future__ import annotations

import random

import pytest

from obsledger.llm.warc import CAPTURE, PERMITTED, resolve_revisits


def plain(rows):
    out = []
    for rid, url, at, kind, _, digest, headers in rows:
        if kind != "revisit":
            continue
        best = None
        if None not in (rid, url, at):
            for r in rows:
                if r[3] == "response" and r[4] == 200 and r[1] == url and None not in (r[0], r[2]) and (r[2], r[0]) < (at, rid):
                    best = r if best is None or (r[2], r[0]) > (best[2], best[0]) else best
        if best is None:
            out.append((rid, None, "no_response", None))
            continue
        own, old = ({k.lower(): v for k, v in (h or {}).items()} for h in (headers, best[6]))
        same = None
        for x, y in ((own.get("etag"), old.get("etag")), (own.get("last-modified"), old.get("last-modified")), (digest, best[5])):
            if same is None and x is not None and y is not None:
                same = x.removeprefix("W/") == y.removeprefix("W/")
        state = "no_validator" if same is None else "resolved" if same else "validator_mismatch"
        merged = None
        if state == "resolved":
            merged = tuple(sorted({**old, **{k: v for k, v in own.items() if k in PERMITTED}}.items()))
        out.append((rid, best[0], state, merged))
    return sorted(out, key=repr)


def captures(seed, n=120):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        url = None if i % 40 == 39 else "http://hot.org/a" if r.random() < 0.4 else f"http://site{r.randrange(9)}.org/p"
        kind = r.choice(["response", "revisit", "revisit", "request"])
        headers = {k: v for k, v in {"ETag": r.choice(["a", "W/a", "b"]), "Last-Modified": r.choice("xy"), "Content-Type": "t", "date": str(i)}.items() if r.random() < 0.6}
        rows.append((i if i % 50 else None, url, None if i % 30 == 29 else r.randrange(20), kind, r.choice([200, 200, 404]), r.choice(["d1", "d2", None]), headers or None))
    return rows


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_scan(spark, seed, rows_per_slice):
    rows = captures(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], CAPTURE + ", url_key string, slice int")
    got = [(r["record_id"], r["response_id"], r["state"], None if r["headers"] is None else tuple(sorted(r["headers"].items()))) for r in resolve_revisits(docs, rows_per_slice).collect()]
    assert sorted(got, key=repr) == plain(rows)


def test_aliases_share_responses(spark):
    rows = [(1, "http://www.a.org/x/?utm_source=f", 1, "response", 200, "d", {}), (2, "https://A.org/x#top", 5, "revisit", 304, "d", {}), (2, "https://A.org/x#top", 5, "revisit", 304, "d", {})]
    got = resolve_revisits(spark.createDataFrame(rows, CAPTURE)).collect()
    assert [(r["response_id"], r["state"]) for r in got] == [(1, "resolved")] * 2


def test_empty_table(spark):
    assert resolve_revisits(spark.createDataFrame([], CAPTURE)).count() == 0
