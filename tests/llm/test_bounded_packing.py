"""Online packing: ids equal the library's, every id once, no padding but for powers of two."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from obsledger.llm import bounded_packing
from obsledger.llm.bounded_packing import Windows, pack_online

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, sequence_id int"


def check(rows, docs, capacity):
    """Pieces of a document tile it, sequences have no gaps; returns number of sequences, pieces and padding."""
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append(np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    ends = {}
    for doc_id, texts in want.items():
        for ids in texts:
            found = pieces[(doc_id, len(ids))]
            at = 0
            while at < len(ids):
                fits = [p for p in found if p[0] == at and p[2] == zlib.crc32(ids[at : at + p[1]].tobytes())]
                assert fits, (doc_id, at)
                found.remove(fits[0])
                at += fits[0][1]
            assert at == len(ids)
    assert not any(pieces.values())
    padding = 0
    for key, spans in places.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        ends[key] = at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return len(places), len(rows), padding


def documents(n, seed):
    random.seed(seed)
    return [(i, " ".join(random.choice("abcdefgh") for _ in range(random.choice([0, 1, 5, 20, 63, 64, 150])))) for i in range(n)]


def test_small_and_odd_rows(spark):
    rows = [(1, "a b c", "x", 1), (2, None, None, None), (3, "", "", 2), (None, "word " * 500, "y", 3), (None, "z", "y", 3), (4, "z " * 63, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pack_online(docs, PATH, 64).collect()
    _, _, padding = check(got, [(r[0], r[1]) for r in rows], 64)
    assert padding == 0
    assert pack_online(docs, PATH, 64).columns == bounded_packing.RESULT
    twice = pack_online(docs.where("doc_id = 4").unionAll(docs.where("doc_id = 4")), PATH, 64).collect()
    assert sorted((r["start"], r["length"]) for r in twice) == [(0, 64), (0, 64)]
    assert pack_online(spark.createDataFrame([], SCHEMA), PATH, 64).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_partitions_and_rounds(spark, monkeypatch, parts):
    monkeypatch.setattr(bounded_packing, "MERGED", 2)
    rows = documents(400, parts)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = pack_online(docs, PATH, 64, windows=3).collect()
    n, pieces, padding = check(got, rows, 64)
    tokens = sum(r["length"] for r in got)
    assert padding == 0 and n <= tokens // 64 + 6
    least = sum(-(-(len(t.split()) + 1) // 64) for _, t in rows)
    assert pieces <= least + n + 6 * parts  # a window costs one cut at most


def test_long_text(spark):
    rows = [(0, "ab " * 900_000), (1, "c"), (2, "x" * 2_500_000)]
    got = pack_online(spark.createDataFrame(rows, "doc_id bigint, text string"), PATH, 2048).collect()
    assert check(got, rows, 2048)[2] == 0


def test_windows_are_bounded_and_best_fit():
    held = Windows(10, 2, 0)
    for doc, size in enumerate([6, 7, 3, 4]):
        held.add(doc, 0, bytes(4 * size), size)
        assert len(held.open) <= 2
    # 3 fills the window of 7, 4 that of 6
    assert [(r[0], r[5], r[6]) for r in held.rows] == [(1, 0, 0), (2, 0, 7), (0, 1, 0), (3, 1, 6)]
    for doc, size in enumerate([6, 7, 8]):
        held.add(doc, 0, bytes(4 * size), size)
    # none fits 8: the fullest takes 3 of it
    assert [(r[0], r[1], r[2]) for r in held.rows[4:]] == [(1, 0, 7), (2, 0, 3)]
    held.close()
    assert [sum(r[2] for r in held.rows if r[5] == s) for s in (3, 4)] == [10, 1]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = pack_online(docs, PATH, 2048).collect()
    n, pieces, padding = check(got, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert padding == 0 and n <= sum(r["length"] for r in got) // 2048 + 11
