"""The pipeline against its operators and brute force, stage by stage."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from obsledger.llm.decontamination import contaminated
from obsledger.llm.toxicity import score_toxicity
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_ngram_join import brute as brute_classes
from tests.llm.test_packing import check

STAGES = dict(corpus_pipeline.STAGES)
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    left = {r["doc_id"]: r for r in docs.collect()}
    for r in score_toxicity(docs, labels).where("predicted = 1").collect():
        left.pop(r["doc_id"])
    first = STAGES["toxicity"](spark, docs, sf_dir)
    assert first.columns == docs.columns and rows_of(first) == sorted((tuple(r) for r in left.values()), key=repr)
    for doc_id, _, component in brute_classes([(i, r["text"]) for i, r in left.items()]):
        if component != doc_id:
            left.pop(doc_id)
    for doc_id, _ in brute_hits([(i, r["text"]) for i, r in left.items()], [tuple(r)[:2] for r in items.select("item_id", "text").collect()]):
        left.pop(doc_id, None)
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    check(pieces, [(i, r["text"]) for i, r in left.items()], 2048)


def test_stages_keep_odd_rows(spark, tmp_path):
    r = random.Random(2)
    text = " ".join(f"w{r.randrange(50)}" for _ in range(60))
    docs = [(5, text, "en", "a", 1), (3, text.upper(), None, None, None), (3, text.upper(), None, None, None), (None, text, "en", "a", 1), (8, None, "x", "y", 0), (9, "", "x", "y", 0)]
    df = spark.createDataFrame(docs, DOCS)
    spark.createDataFrame([(1, "alpha beta gamma delta. epsilon zeta eta")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert Counter(map(tuple, STAGES["toxicity"](spark, df, str(tmp_path)).collect())) == Counter(docs)
    kept = STAGES["ngram_jaccard_join"](spark, df, str(tmp_path))
    assert kept.columns == df.columns and Counter(map(tuple, kept.collect())) == Counter(docs[1:])
    leak = spark.createDataFrame([*docs, (11, "x ALPHA beta gamma, delta epsilon zeta eta y", "", "", 1)], DOCS)
    clean = STAGES["benchmark_decontamination"](spark, leak, str(tmp_path))
    assert Counter(map(tuple, clean.collect())) == Counter(docs)
    assert contaminated(leak, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).first()["doc_id"] == 11


def test_every_text_keeps_a_document(spark, sf_dir):
    r = random.Random(4)
    a, b = (" ".join(f"{x}{r.randrange(90)}" for _ in range(60)) for x in "ab")
    docs = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (3, b, "en", "s", 1), (9, a, "en", "s", 1), (7, None, "en", "s", 1), (7, "", "en", "s", 1)]
    kept = STAGES["ngram_jaccard_join"](spark, spark.createDataFrame(docs, DOCS), sf_dir)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([docs[0], docs[2], docs[4], docs[5]], key=repr)


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
