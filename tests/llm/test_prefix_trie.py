"""The conversation trie against a plain loop over all prefixes."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from obsledger.llm import prefix_trie
from obsledger.llm.prefix_trie import RESULT, conversation_trie, prefix_names

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, name binary"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c, ts in own.items():
        h = crc32(str(c).encode()) % 9
        convs[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + ts[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves = 0 if children[node] else 1
        for child in children[node]:
            leaves += totals[child][0]
            saved += totals[child][1]
        totals[node] = (leaves, saved)
    out = []
    for node, m in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *totals[node], digest))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(RESULT).collect()), key=repr)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA).repartition(parts)


def conversations(seed, n, longest):
    random.seed(seed)
    rows = []
    for c in range(n):
        if random.random() < 0.1:
            continue
        length = random.choice([1, 2, 3, 8, longest])
        for turn in range(length):
            text = random.choice(["hi", "hi", "hi", "ok é", None, ""])
            rows.append((c, None if turn == 0 and random.random() < 0.2 else turn, random.choice(["user", None]) if turn == 0 else "user", text))
    return rows


@pytest.mark.parametrize(("segment", "longest"), [(256, 20), (4, 37), (2, 21), (16, 16)])
def test_equals_plain_loop(spark, monkeypatch, segment, longest):
    monkeypatch.setattr(prefix_trie, "TURNS_PER_BUCKET", 6)
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK_NODES", 40)
    rows = conversations(segment, 60, longest)
    rows += [(c, t, "user", "hi") for c in range(100, 140) for t in range(12)]  # one conversation many times
    assert got(conversation_trie(frame(spark, rows), segment)) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (-7, 3, None, None), (-7, None, "a", "b"), (-5, 1, "user", "x"), (2**40 + 3, 0, "é", "漢字"), (5, 1, "u", "t"), (5, 1, "u", "t")]
    rows += [(6, 0, "user", "only")]
    assert got(conversation_trie(frame(spark, rows))) == plain(rows)
    assert conversation_trie(frame(spark, [(None, 1, "u", "t")])).count() == 0
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_and_conversations(spark):
    rows = [(1, t, "user", "same") for t in range(3000)] + [(0, t, "user", "same") for t in range(2900)] + [(11, 0, "user", "z" * 2_500_000)]
    assert got(conversation_trie(frame(spark, rows), 64)) == plain(rows)


def test_names_do_not_depend_on_what_follows():
    tokens = [bytes([i]) * 16 for i in range(16)]
    for n in range(16):
        assert prefix_names(b"r" * 16, None, tokens[:n], 16) == prefix_names(b"r" * 16, None, tokens, 16)[: n + 1]


def test_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert got(conversation_trie(table)) == plain(rows)
