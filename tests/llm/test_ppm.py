"""The trie against a plain recursive model; base scores against counting; held-out gain."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from obsledger.llm import ppm
from obsledger.llm.ppm import Trie, grams, score_documents, text_scores, word_tokens

SCHEMA = "doc_id bigint, text string, score string, n_tokens int"


def packed(parts):
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def edges_of(parts, order, least=1):
    _, values = grams(*packed(parts), order)
    out = []
    for k in range(order + 1):
        keys, counts = np.unique(values & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)
        out.append((keys[counts >= least], counts[counts >= least]))
    return out, len(values)


class Plain:
    def __init__(self, parts, order, least):
        self.order, full = order, Counter()
        for p in parts:
            stream = b"\n" * order + p + b"\xff"
            for i in range(order, len(stream)):
                for k in range(order + 1):
                    full[stream[i - k : i + 1]] += 1
        self.full = full
        self.kept = {}
        for g, n in full.items():
            if n >= least:
                self.kept.setdefault(g[:-1], {})[g[-1]] = n
        self.places = sum(n for g, n in full.items() if len(g) == 1)

    def distribution(self, context):
        """Log-free probabilities of all 256 symbols behind a context."""
        p, mass, excluded = {}, 1.0, set()
        for k in range(self.order, -1, -1):
            c = context[len(context) - k :]
            seen = self.kept.get(c)
            if not seen:
                continue
            total = self.places if k == 0 else max(self.full.get(c, 0), sum(seen.values()))
            own = {s: n for s, n in seen.items() if s not in excluded}
            rest = total - sum(n for s, n in seen.items() if s in excluded)
            escape = 2 * (total - sum(seen.values())) + len(own)
            if rest <= 0:
                excluded |= set(seen)
                continue
            for s, n in own.items():
                p[s] = mass * (2 * n - 1) / (2 * rest)
            mass *= escape / (2 * rest) if escape > 0 else 1
            excluded |= set(seen)
        for s in set(range(256)) - excluded:
            p[s] = mass / (256 - len(excluded))
        return p


@pytest.mark.parametrize(("order", "least"), [(2, 1), (3, 1), (3, 4), (6, 3)])
def test_equals_plain_model(order, least):
    r = random.Random(order)
    words = ["the", "cat", "sat", "on", "mat", "é", "zz", "a\n"]
    train = [" ".join(r.choice(words) for _ in range(r.randint(0, 30))).encode() for _ in range(40)]
    test = train[:3] + [b"", b"the dog", "völlig neu".encode(), b"the cat sat", b"q" * 9]
    edges, places = edges_of(train, order, least)
    trie, plain = Trie.of(edges, places), Plain(train, order, least)
    want = []
    for t in test:
        stream, score = b"\n" * order + t + b"\xff", 0.0
        for i in range(order, len(stream)):
            p = plain.distribution(stream[i - order : i])
            if least == 1:
                assert abs(sum(p.values()) - 1) < 1e-9
            score += math.log10(p[stream[i]])
        want.append(score)
    assert np.allclose(text_scores(*packed(test), trie), want)


def test_grams_by_hand():
    parts = [b"", b"ab", "é".encode() * 9, bytes(range(256)), b""]
    for order in (0, 2, 6, 7):
        want = []
        for i, p in enumerate(parts):
            stream = b"\n" * order + p + b"\xff"
            want += [(i, int.from_bytes(stream[at - order : at + 1])) for at in range(order, len(stream))]
        rows, values = grams(*packed(parts), order)
        assert list(zip(rows.tolist(), values.tolist())) == want


def test_lookups_come_in_order():
    """In any other order, each lookup in a long dictionary leaves the cache."""
    rows, values = grams(*packed([b"the cat sat on the mat " * 20, b"another text", b"the cat"]), 6)
    got_rows, got, first = ppm.by_gram(rows, values)
    assert sorted(zip(got.tolist(), got_rows.tolist())) == sorted(zip(values.tolist(), rows.tolist()))
    assert (np.diff(got.astype(np.int64)) >= 0).all()
    assert got[first].tolist() == sorted(set(values.tolist()))


def base_rows(rows):
    def held(d):
        return d is not None and zlib.crc32(str(d).encode()) % 5 == 1

    counts = Counter(t for d, x in rows if not held(d) for t in word_tokens((x or "").encode()))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, x in rows:
        tokens = word_tokens((x or "").encode())
        base = sum(math.log10((counts.get(t, 0) + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out.append((d, held(d), len(tokens), sum(t in counts for t in tokens), n, round(base, 6)))
    return sorted(out, key=repr)


def as_rows(got):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr)


def test_small_and_odd_rows(spark):
    rows = [(i, f"the Cat {i % 7} sat\tON\x0bthe mat {'x' * i}") for i in range(40)] + [(41, None), (42, ""), (None, "the end"), (3, "the Cat 3 sat\tON\x0bthe mat xxx")]
    got = score_documents(spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)).collect()
    assert as_rows(got) == base_rows(rows)
    assert all(r["score"] < 0 for r in got)


@pytest.mark.parametrize("common", [30, 4_000_000])
def test_scores_equal_plain_model(spark, monkeypatch, common):
    """Every edge counts, single ones too, whether a gram is in the dictionary or joined."""
    monkeypatch.setattr(ppm, "EDGES", common)
    r = random.Random(5)
    words = ["the", "cat", "sat", "on", "mat", "é", "zz", "a\n", "once7"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 30))) + f" {r.random()}") for i in range(60)]
    rows += [(None, "a null id"), (60, None), (2, rows[2][1]), (61, ""), (62, "völlig neu 漢字")]
    held = [zlib.crc32(str(d).encode()) % 5 == 1 if d is not None else False for d, _ in rows]
    assert any(held)
    plain = Plain([(t or "").encode() for (_, t), h in zip(rows, held) if not h], ppm.ORDER, 1)
    want = []
    for d, t in rows:
        stream = b"\n" * ppm.ORDER + (t or "").encode() + b"\xff"
        score = sum(math.log10(plain.distribution(stream[i - ppm.ORDER : i])[stream[i]]) for i in range(ppm.ORDER, len(stream)))
        want.append((-1 if d is None else d, score))
    got = [(-1 if g["doc_id"] is None else g["doc_id"], g["score"]) for g in score_documents(spark.createDataFrame([(*x, "", 0) for x in rows], SCHEMA)).collect()]
    assert [d for d, _ in sorted(got)] == [d for d, _ in sorted(want)]
    assert np.allclose([s for _, s in sorted(got)], [s for _, s in sorted(want)])


def test_empty_and_untrained(spark):
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = score_documents(spark.createDataFrame([(only, "ab", "", 0)], SCHEMA)).first()
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and abs(got["score"] + 3 * math.log10(256)) < 1e-9


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = score_documents(docs).collect()
    assert as_rows(got) == base_rows(rows)
    assert all(r["score"] <= 0 for r in got)


def test_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = score_documents(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]
