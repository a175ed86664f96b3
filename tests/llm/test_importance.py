"""Importance resampling against a plain loop over whole texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from obsledger.llm import importance
from obsledger.llm.importance import resample

SCHEMA = "doc_id bigint, text string, score string, rank int, line binary"


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, len(words)])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    places = {id(r): i + 1 for i, r in enumerate(able[: 25 * len(able) // 100])}
    return sorted(((*r[:4], places.get(id(r))) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def texts(n, seed):
    random.seed(seed)
    words = ["alpha", "Beta", "x1", "été", "漢字", "no", "İ", "ﬁ", "don't", "a_b", "٣"]
    seps = [" ", "  ", "\n", "\n\n", ", ", "\r\n", "\t", " \n ... \n", "\x0b", " ", "\u0085"]
    lines = ["the same line in many texts", "another one, the same", "...", ""]
    out = []
    for i in range(n):
        parts = []
        for _ in range(random.choice([0, 1, 3, 30])):
            parts += [random.choice(words) if random.random() < 0.8 else "\n" + random.choice(lines) + "\n", random.choice(seps)]
        out.append((i, "".join(parts)))
    return out


@pytest.mark.parametrize("common", [3, 100_000])
def test_equals_plain_loop(spark, monkeypatch, common):
    monkeypatch.setattr(importance, "COMMON", common)
    monkeypatch.setattr(importance, "BLOCK_BYTES", 300)
    monkeypatch.setattr(importance, "MERGED", 2)
    docs = texts(300, 5) + [(1000, None), (1001, ""), (-3, "...\n...")]
    target = ["Alpha beta x1", "alpha\nthe same line", None, ""]
    frame = spark.createDataFrame([(*d, "x", 3, None) for d in docs], SCHEMA).repartition(5)
    assert got(resample(frame, spark.createDataFrame([(t, 1) for t in target], "text string, n int"))) == plain(docs, target)


def test_ties_repeats_and_empty_tables(spark):
    docs = [(1, "alpha " * 25)] * 3 + [(2, "beta " * 30), (None, "x " * 21), (None, "x " * 21), (3, "same\n" * 20), (4, None)]
    frame = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA)
    none = spark.createDataFrame([], "text string")
    assert got(resample(frame, none)) == plain(docs, [])
    assert resample(frame.where("false"), none).count() == 0
    assert got(resample(frame.where("doc_id = 4"), none))[0][1:3] == (0, 0)


def test_long_text(spark):
    docs = [(1, "word other " * 120_000), (2, "ab\n" * 800_000), (3, "y" * 2_500_000)]
    assert got(resample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([("other",)], "text string"))) == plain(docs, ["other"])


def test_documents(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert got(resample(docs, target)) == want
