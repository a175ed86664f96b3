"""Digests against a plain loop over windows; the edited text and its neighbour by sorting."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from obsledger.llm import fingerprints as P
from obsledger.llm.fingerprints import class_ranks, digests, entropy_classes, fingerprint_documents, likeness, select_features

SCHEMA = "doc_id bigint, text string, n_chars string, bucket int, guest int"


def packed(parts):
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def entropy(window):
    h = sum(round(c * math.log2(c) * 65536) for c in Counter(window).values())
    return (round(64 * 6 * 65536) - h) * 1000 // round(64 * 6 * 65536)


def plain_features(text, ranks):
    if not text:
        return []
    windows = [(ranks[entropy(text[i : i + 64])], i) for i in range(len(text) - 63)]
    votes = Counter()
    for s in range(max(1, len(windows) - 63)) if windows else []:
        known = [w for w in windows[s : s + 64] if w[0] >= 0]
        if known:
            votes[min(known)[1]] += 1
    if not votes:
        return [(0, len(text))]
    out = sorted(i for i, v in votes.items() if v >= 16) or [min(votes, key=lambda i: (-votes[i], i))]
    return [(i, i + 64) for i in out]


def samples(seed):
    r = random.Random(seed)
    words = [bytes(r.choice(b"abcdefgh zyx.,") for _ in range(r.randint(1, 9))) for _ in range(50)]
    texts = [b" ".join(r.choice(words) for _ in range(r.choice([0, 1, 12, 30, 200]))) for _ in range(25)]
    return texts + [b"", b"a", b"a" * 500, b"x" * 64, b"y" * 63, words[0] * 80, bytes(range(1, 127)) * 3, b""]


@pytest.mark.parametrize("seed", range(3))
def test_features_equal_plain_loop(seed, monkeypatch):
    if seed:
        monkeypatch.setattr(P, "BLOCK", 100)
    texts = samples(seed)
    data, offsets = packed(texts)
    starts, classes = entropy_classes(data, offsets)
    want = [(o + i, entropy(t[i : i + 64])) for o, t in zip(offsets, texts) for i in range(len(t) - 63)]
    assert list(zip(starts.tolist(), classes.tolist())) == want
    ranks = class_ranks(np.bincount(classes, minlength=1001))
    row, first, end = select_features(data, offsets, ranks)
    got = [[(int(a - offsets[i]), int(b - offsets[i])) for a, b in zip(first[row == i], end[row == i])] for i in range(len(texts))]
    assert got == [plain_features(t, ranks) for t in texts]


def test_likeness():
    texts = [t for t in samples(5) if len(t) > 300]
    ranks = class_ranks(np.arange(1001))
    own = digests(*packed(texts), ranks)
    edited = digests(*packed([t[: len(t) * 2 // 3] + u[: len(t) // 3] for t, u in zip(texts, texts[1:])]), ranks)
    assert all(likeness(d, d) == 1 for d in own) and likeness([], []) == 1 and likeness([], own[0]) == 0
    for d, e in zip(own, edited):
        assert 0 <= likeness(d, e) <= 1 and likeness(d, e) == likeness(e, d)
    long = digests(*packed([bytes(random.Random(1).choices(range(256), k=60_000))]), ranks)[0]
    assert len(long) > 1 and all(n <= 160 for n, _ in long)


def expected(rows):
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    out = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        edited = t[: len(t) - len(t) // 3] + u[: len(t) // 3]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("count", [0, 1, 2, 60])
def test_rows(spark, count):
    texts = [*samples(7), *samples(8)]
    rows = [(i * 7 % 101, texts[i].decode() + "é漢") for i in range(count)]
    if count > 2:
        rows += [(None, "null id"), (-5, None), (1000, ""), (500, "same " * 40), (499, "same " * 40)]
    got = fingerprint_documents(spark.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == expected(rows)
    by_text = {r["doc_id"]: r for r in got}
    if count > 2:
        assert by_text[500]["fingerprint"] == by_text[499]["fingerprint"] and by_text[500]["near_next"] == 1
        assert by_text[1000]["fingerprint"] == "" and all(0 <= r["near_edited"] <= 1 for r in got)


def test_repeated_rows_keep_a_result_each(spark):
    rows = [(3, "a b"), (3, "a b"), (2, "c"), (3, "other")]
    got = fingerprint_documents(spark.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in got) == [2, 3, 3, 3]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fingerprint_documents(docs).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == expected(rows)
    long = [r for r in got if r["n_chars"] > 2000]
    near = sum(r["near_edited"] for r in long) / len(long)
    far = sum(r["near_next"] for r in long) / len(long)
    assert near > 0.4 and far < 0.1, (near, far)
