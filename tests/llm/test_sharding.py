"""Shards of equal bytes: whole order by brute force, hot keys, odd rows."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from obsledger.llm import sharding
from obsledger.llm.sharding import sampled_splitters, shard_documents

SCHEMA = "doc_id bigint, text string, size string, shard int"


def check(rows, docs, shards):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(
        ((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs), key=repr
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share, largest = sum(sizes.values()) / shards, max((r["size"] for r in rows), default=0)
    assert all(abs(sizes[s] - share) <= largest for s in range(shards))


@pytest.mark.parametrize("overfull", [2.0, 0.2])
def test_hot_text_is_subdivided(spark, overfull, monkeypatch):
    monkeypatch.setattr(sharding, "OVERFULL", overfull)
    docs = [(i, "same text" if i % 3 else f"text {i} " * (i % 11)) for i in range(600)] + [(5, None), (None, "x"), (7, "same text"), (7, "same text")]
    check(shard_documents(spark.createDataFrame([(*d, "x", 9) for d in docs], SCHEMA), 6).collect(), docs, 6)


def test_order_is_whole(spark):
    rows = [((i * 37) % 101, i, i * 1000, 1 + i % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "_k bigint, _d bigint, _r bigint, size bigint").withColumn("id", F.col("_d"))
    got = {r["id"]: (r["shard"], r["slot"]) for r in sampled_splitters(df, 5).collect()}
    want, at, seen = {}, 0, defaultdict(int)
    for k, d, r, size in sorted(rows):
        shard = min(4, int((at + size - (at + size - at) / 2) * 5 // sum(x[3] for x in rows)))
        want[d] = (shard, seen[shard])
        seen[shard] += 1
        at += size
    assert got == want


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA), 24).count() == 0


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(shard_documents(docs, 24).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 24)
