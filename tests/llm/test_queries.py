"""The registered queries: contracts' columns and types, and SQL where there is some."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from obsledger.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

CONTRACTS = {
    "op2_sampled_splitters": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op4_partial_matching": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op5_pre_token_counts": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op6_improbable_features": "doc_id:bigint n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string near_edited:double near_next:double",
    "op7_exact_complement": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op8_redirect_equivalence": "page_id:bigint host:string path:string rule:string verdict:string",
    "op9_boosted_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op10_grouped_prefix_join": "doc_id:bigint n_shingles:bigint component_id:bigint",
    "op11_halved_prefix_trie": "conv_id:bigint depth:bigint parent_conv_id:bigint n_convs:bigint n_children:bigint n_leaves:bigint saved_tokens:bigint ends_sha256:string",
    "op12_segment_deduplicated_resampling": "doc_id:bigint n_features:bigint weight:bigint score:bigint rank:bigint",
    "op13_bounded_space_packing": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")) == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    kinds = dict(df.dtypes)
    want = dict(c.split(":") for c in CONTRACTS[name].split())
    assert {c: kinds[c] for c in want} == want
    table = "pages" if name.startswith("op8") else "conversations" if name.startswith("op11") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    found = df.count()
    assert found == rows or name.startswith(("op7", "op13")) and found > rows or name.startswith("op11") and found > 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []
