"""Packing: ids equal the library's, pieces tile sequences, few sequences."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from obsledger.llm.packing import pack_documents, packing_plan
from obsledger.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, piece int"


def check(rows, docs, capacity):
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            want[(doc_id, k, s, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything(seed):
    random.seed(seed)
    capacity = random.choice([7, 64, 2048])
    counts = {x: random.choice([1, 2, 50, 4000]) for x in random.sample(range(1, capacity + 1), min(capacity, 60))}
    plan = packing_plan(counts, capacity)
    placed = Counter()
    for pattern, times in plan:
        assert 0 < sum(pattern) <= capacity and times > 0
        for x in pattern:
            placed[x] += times
    assert placed == counts
    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    over_half = sum(n for x, n in counts.items() if 2 * x > capacity)
    assert sum(t for _, t in plan) <= 1.25 * max(least, over_half) + 1


def test_words_are_independent():
    tok, own = Tokenizer.from_file(PATH), WordIds(PATH)
    parts = ["It's", "ÀΣ", "a\u0301", "\u0301", "<|endoftext|>", "<|EndOfText|>", "x<|startoftext|>y", "12", "0", "٠", "０", "a.", "b,", "..", "…!", " "]
    parts += [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\u3000", "\u00a0", "漢字", "\x1c", "\x85", "Ⅳ", "don't.", "K", "İ", "ß", "Word", "the", "<", "|>"]
    random.seed(1)
    texts = ["".join(random.choice(parts) for _ in range(random.choice([1, 4, 12]))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_and_slices():
    tok, own = Tokenizer.from_file(PATH), WordIds(PATH)
    texts = [None, "", "é" * 700_000 + " x.", "Naïve, straße! ŉ ǆ Ǆ. " * 50, "a" * 300 + "..."] + [f"w{i} Žluť{i}kůň." for i in range(3000)]
    column = pa.array(texts * 2, pa.string()).slice(3, 2500)
    ids, bounds = own.column(column)
    for text, a, b in zip(column.to_pylist(), bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tok.encode(text or "", add_special_tokens=False).ids


def test_small_generations(monkeypatch):
    monkeypatch.setattr("obsledger.llm.word_ids.WORDS_KEPT", 5)
    tok, own = Tokenizer.from_file(PATH), WordIds(PATH)
    for k in range(30):
        text = f"the cat{k % 7}, cat{k % 3}. sees xyz the{'e' * (k % 5)}! " + "y" * 70
        (ids,) = own.encode([text.encode()])
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(own.young) <= 5 + 12 and len(own.old) <= 5 + 12


def test_small_and_odd_rows(spark):
    rows = [(1, "a b c", "x", 1), (1, "a b c", "x", 1), (2, None, None, None), (3, "", "", 2), (None, "word " * 500, "y", 3), (4, "z " * 63, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pack_documents(docs, PATH, 64).collect()
    check(got, [(r[0], r[1]) for r in rows], 64)
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH, 64).count() == 0


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack_documents(docs, PATH, 2048).collect()
    n = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert n <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1
