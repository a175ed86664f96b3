"""Token counts against the tokenizer itself."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from obsledger.llm.token_counts import count_pieces, piece_counts, pre_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, n_tokens string, token int"
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "\n", "\na", "a\n", "a\n\n b  \n  c", "<s> x </s> <unk>", "▁▁a▁b ▁",
    "tab\there\r\nline\x0b\x0c end\x00", "naïve Ωmega 漢字 　 ﬁ 🙂🙂", "x" * 3000, "of.\nThe  end", "1234 5,6",
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_pre_tokens_add_up(model):
    random.seed(3)
    mixed = ["".join(random.choice(["a", "the", " ", "  ", "\n", "▁", "é", "<s>", "9", "\t"]) for _ in range(40)) for _ in range(400)]
    for text in TEXTS + mixed:
        assert sum(piece_counts(pre_tokens(text.encode()), PATH)) == len(model.encode(text)), repr(text)


def test_counts_equal_the_library(spark, model):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(1, TEXTS[10], "x", 2), (None, "null id", None, None), (90, None, None, None)]
    got = count_pieces(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    want = [(r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert count_pieces(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_documents(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in count_pieces(docs, PATH).collect()}
    assert got == {r["doc_id"]: len(model.encode(r["text"])) for r in docs.collect()}
