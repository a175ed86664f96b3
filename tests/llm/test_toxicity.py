"""Features by hand, held-out accuracy, odd tables."""

from __future__ import annotations

import zlib

import numpy as np

from obsledger.llm.toxicity import FEATURES, Lexicon, features, score_toxicity, without_toxic, word_key

DOCS = "doc_id bigint, text string, score string, x int, fold string, probability double"
LABELS = "doc_id bigint, toxic int, text string"


def look(*texts):
    parts = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    keys = np.sort(np.array([word_key("idiot"), word_key("été")], np.uint64))
    values = features(np.frombuffer(b"".join(parts), np.uint8), offsets, Lexicon(keys, np.array([2.0, 2.0])))
    return [dict(zip(FEATURES, map(float, v))) for v in values]


def test_features():
    plain, hidden, far, loud, empty = look("you are an IDIOT, idiot", "an 1d!0t in ÉTÉ", "you a b c d e idiot", "WHY SO LOUD!!", "")
    assert plain["hit_count"] == np.log1p(1) and plain["hit_max"] == 2 and plain["hit_weight_density"] == 2 / 5
    assert plain["near_count"] == np.log1p(2) and plain["second_density"] == 1 / 5 and plain["capital_words"] == 1 / 5
    assert hidden["hidden_count"] == np.log1p(1) and hidden["hit_count"] == np.log1p(1)  # ÉTÉ in lower case
    assert far["near_count"] == 0 and far["hit_count"] == np.log1p(1)
    assert loud["capital_share"] == 1 and abs(loud["exclamation"] - 2 / 13) < 1e-12
    assert set(empty.values()) == {0.0}


def test_neighbours_do_not_matter():
    alone = [look(t)[0] for t in ("you", "idiot x", "", "a 1d1ot")]
    assert look("you", "idiot x", "", "a 1d1ot") == alone


def made_up():
    docs = [(i, ("you idiot " if i % 4 == 0 else "") + f"word{i % 9} and more text here {i}", None, 1, "f", 0.5) for i in range(300)]
    labels = [(i, int(i % 4 == 0), "t") for i in range(250)]
    return docs, labels


def test_odd_rows(spark):
    docs, labels = made_up()
    docs += [(None, "you idiot again", "s", None, None, None), (901, None, "s", None, None, None), (902, "", "s", None, None, None), (4, docs[4][1], "s", None, None, None)]
    labels += [(None, 1, "t"), (5000, 1, "t"), (8, None, "t"), (8, 1, "t")]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = score_toxicity(d, b).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[901]["score"] == by_id[902]["score"] and by_id[None]["predicted"] == 1
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 300)
    kept = without_toxic(d, b)
    assert kept.columns == d.columns
    want = [tuple(r) for r in docs if r[1] is None or "idiot" not in r[1]]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    docs, labels = (spark.createDataFrame(r, s) for r, s in zip(made_up(), (DOCS, LABELS)))
    assert score_toxicity(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert without_toxic(docs, labels.limit(0)).count() == docs.count()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    caught = [r["predicted"] for r in got if r["toxic"] == 1]
    wrong = [r["predicted"] for r in got if r["toxic"] == 0]
    assert sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.02
