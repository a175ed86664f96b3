"""The join against all pairs compared one by one."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from obsledger.llm import ngram_join
from obsledger.llm.ngram_join import similar_documents

SCHEMA = "doc_id bigint, text string, n string, token int, node string"


def brute(rows):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        k = max(len(words) - 4, 1)
        sets.append({tuple(words[i : i + 5]) for i in range(k)} if words else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def made_up(seed, n):
    """Families of edited copies, shared passages, short and odd texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(r.choice(vocabulary) for _ in range(40))
    rows = []
    while len(rows) < n:
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 6, 20, 60, 150]))]
        for _ in range(r.choice([1, 1, 2, 12])):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 25))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = r.choice([" ", "\n", "\t "]).join(words)
            rows.append(text if r.random() < 0.8 else f"{text} {passage}")
    rows += ["", " \n", None, "A b", "a B", "ÄÖ x y z w v", "äö x y z w v", "a b c d e", "A B  C\tD e"]
    ids = r.sample(range(10 * n), len(rows))
    out = [(i, t) for i, t in zip(ids, rows)]
    return out + out[:3] + [(None, out[0][1]), (None, None), (None, "only here is this text of words")]


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(ngram_join, "FREQUENT_DF", 3)
    rows = made_up(seed, 120)
    docs = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in similar_documents(docs).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in similar_documents(docs).collect()), key=repr) == brute(rows)


def test_counting_takes_little_memory():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.uint64)
    hashes[::3] = hashes[0]
    want, times = np.unique(hashes >> np.uint64(ngram_join.TOKEN_SHIFT), return_counts=True)
    held = [hashes[:150_000].copy(), hashes[150_000:].copy()]
    tracemalloc.start()
    tokens, counts = ngram_join._counted(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens.tolist() == want.tolist() and counts.tolist() == times.tolist() and not held
    assert peak < 3 * hashes.nbytes  # np.unique takes 4 to 5 times


def test_sets_are_compared_in_place():
    sets = [np.arange(i, dtype=np.uint64) for i in (3, 0, 2000, 70_000)]
    column = pa.array([s.tobytes() for s in sets], pa.binary())
    tracemalloc.start()
    got = ngram_join._set_views(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g.tolist() for g in got] == [s.tolist() for s in sets] and peak < 100_000
    assert [g.tolist() for g in ngram_join._set_views(column.slice(2))] == [s.tolist() for s in sets[2:]]
    assert ngram_join._set_views(column.slice(0, 0)) == []
