"""Retrieval against plain BM25 over every passage and item."""

from __future__ import annotations

import math
import random
import re

import pytest

from obsledger.llm import decontamination as D
from obsledger.llm.decontamination import contaminated, question_and_answer

DOCS = "doc_id bigint, text string, item_id string, score int"
ITEMS = "item_id bigint, text string, doc_id string"


def split(text):
    return [w.lower() for w in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", text or "")]


def brute(docs, items):
    texts = [(i, split(t), [split(p) for p in question_and_answer(t or "")]) for i, t in items]
    texts = [x for x in texts if x[1]]
    if not texts:
        return []
    n, mean = len(texts), sum(len(w) for _, w, _ in texts) / len(texts)
    df = {}
    for _, w, _ in texts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1

    def weights(w):
        return {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in set(w)}

    index = [(i, weights(w), parts) for i, w, parts in texts]
    size = max(D.BUCKET_WORDS, max(len(w) for _, w, _ in texts))
    out = []
    for doc_id, text in docs:
        words = split(text)
        for item_id, weight, parts in index:
            for begin in range(0, max(1, len(words)), size):
                passage = words[begin : begin + 2 * size]
                score = sum(weight.get(t, 0) for t in set(passage)) / sum(weight.values())
                shares = []
                for part in parts:
                    k = min(3, len(part))
                    grams = {tuple(part[j : j + k]) for j in range(len(part) - k + 1)} if k else set()
                    have = {tuple(passage[j : j + k]) for j in range(len(passage) - k + 1)}
                    shares.append(len(grams & have) / len(grams) if grams else 0)
                if score >= 0.5 and min(shares) >= 0.5:
                    out.append((doc_id, item_id))
                    break
    return sorted(out, key=repr)


def made_up(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["the", "of", "a"] * 15
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 6, 15, 30]))) + r.choice([".", "?", ""])) for i in range(40)]
    items = [(i, t if r.random() < 0.5 else f"{t} Then: {r.choice(words)} is {r.choice(words)}.") for i, t in items]
    items += [(40, None), (41, ""), (42, "... !"), (None, items[3][1]), (5, items[5][1])]
    docs = []
    for d in range(60):
        text = [r.choice(words) for _ in range(r.choice([0, 5, 60, 400]))]
        for _ in range(r.choice([0, 1, 2])):
            item = (r.choice(items)[1] or "").upper().split()
            for _ in range(r.choice([0, 0, 1, 4])):
                if item:
                    item[r.randrange(len(item))] = "edit,"
            cut = r.randrange(len(text) + 1)
            text[cut:cut] = item
        docs.append((d, " ".join(text)))
    return docs + [(7, docs[7][1]), (None, items[3][1]), (99, None)], items


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_bm25(spark, seed, monkeypatch):
    if seed == 2:  # several parts, several chunks of bounds
        monkeypatch.setattr(D, "PART_ITEMS", 15)
        monkeypatch.setattr(D, "CELLS", 20)
    docs, items = made_up(seed)
    got = contaminated(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, None) for i in items], ITEMS))
    assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=repr) == brute(docs, items)


def test_exact_copies_of_items_with_lone_marks(spark):
    """A closing mark, dots or an opening mark alone are no part of their own."""
    texts = ['did the old man go home late? he said yes . "', "( see the table above . )", "who was the first to sail . . .", "... nobody knew where it had gone. up north!", "word . )"]
    items = [(i, t) for i, t in enumerate(texts)]
    for text in texts:
        assert all(split(part) for part in question_and_answer(text)), text
    docs = [(10 + i, f"filler one two {t} filler three four") for i, t in items] + [(99, "filler one two . ) \" three four")]
    got = contaminated(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, None) for i in items], ITEMS))
    found = sorted((r["doc_id"], r["item_id"]) for r in got.collect())
    assert found == [(10 + i, i) for i, _ in items] == brute(docs, items)
    left = D.decontaminated(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([(*i, None) for i in items], ITEMS))
    assert [r["doc_id"] for r in left.collect()] == [99]


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c", None)], ITEMS)
    assert contaminated(none, items).count() == 0
    assert contaminated(spark.createDataFrame([(1, "a b c", "", 0)], DOCS), items.limit(0)).count() == 0


def test_documents_hold_their_passages(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, tests = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], [(r[0], r[1]) for r in items.collect()]
    got = sorted(((r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()), key=repr)
    assert got == brute(rows, tests)
    assert {(d, i) for d, t in rows for i, x in tests if x in t} <= set(got)
