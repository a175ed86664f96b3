"""One text of more than two megabytes between short ones, for every operator on documents and the pipeline."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from obsledger.llm.decontamination import contaminated
from obsledger.llm.fingerprints import fingerprint_documents
from obsledger.llm.ngram_join import similar_documents
from obsledger.llm.ppm import score_documents
from obsledger.llm.sharding import shard_documents
from obsledger.llm.token_counts import count_pieces
from obsledger.llm.toxicity import score_toxicity

ITEM = "Which river flows past the quiet harbour town of Elmswick? The slow green river Tarn."


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    words = [f"{a}{b}" for a in "ba co di fu ge ha ji ko lu mé".split() for b in "lan ren tos vik mar den".split()]
    long = " ".join(r.choice(words) for _ in range(420_000))
    assert len(long.encode()) > 2 << 20
    return {1: long, 2: long[:-7000], 3: long[: len(long) // 2] + " " + ITEM, 4: "a short text", 5: None, 6: "", 7: "q" * 2_200_000, 8: "a short text"}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint").cache()


def test_shards(docs, texts):
    rows = shard_documents(docs, 3).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len((t or "").encode()) + 8 for i, t in texts.items()}


def test_benchmark_item_at_the_end(spark, docs):
    found = contaminated(docs, spark.createDataFrame([(9, ITEM)], "item_id bigint, text string"))
    assert {r["doc_id"] for r in found.collect()} == {3}


def test_scores(docs, texts):
    rows = {r["doc_id"]: r for r in score_documents(docs).collect()}
    assert {i: r["n_tokens"] for i, r in rows.items()} == {i: len((t or "").split()) + 1 for i, t in texts.items()}
    assert all(r["score"] < 0 for r in rows.values()) and rows[4]["score"] == pytest.approx(rows[8]["score"])


def test_piece_counts(docs, texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r["doc_id"]: r["n_tokens"] for r in count_pieces(docs.where("doc_id <> 7"), path).collect()} == {i: len(library.encode(t or "")) for i, t in texts.items() if i != 7}


def test_fingerprints(docs, texts):
    rows = {r["doc_id"]: r for r in fingerprint_documents(docs).collect()}
    assert {i: r["n_chars"] for i, r in rows.items()} == {i: len(t or "") for i, t in texts.items()}
    assert rows[4]["fingerprint"] == rows[8]["fingerprint"] and rows[2]["near_edited"] > 0.9
    assert rows[2]["near_next"] > 0.9 and rows[7]["near_next"] == 0  # text 1 goes on where text 2 ends; text 6 is empty


def test_similar(docs):
    assert {r["doc_id"]: r["component_id"] for r in similar_documents(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 4}


def test_toxicity_and_pipeline(spark, docs, sf_dir, tmp_path, texts):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.withColumn("doc_id", docs.doc_id + 1_000_000)
    given.unionByName(more.select(given.columns)).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    scored = score_toxicity(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert all(0 <= r["score"] <= 1 for r in scored.where("doc_id > 1000000").collect())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).where("doc_id > 1000000").collect()
    kept = {r["doc_id"] - 1_000_000 for r in pieces}
    assert 1 in kept and 2 not in kept and len(kept & {4, 8}) <= 1
    assert sorted((r["start"], r["start"] + r["length"]) for r in pieces if r["doc_id"] == 1_000_001)[0][0] == 0
