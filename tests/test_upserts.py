"""Upserts, marking and limits: neither side alone is the answer, and nothing is cut unasked."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.operators import schema_evolution as E
from obsledger.plans import QUERIES, canonical_queries, graph_queries, model_queries
from obsledger.operators import review as R
from tests.conftest import rows


def test_upsert_queries_tell_the_sides_apart(spark, sf_dir):
    """The answer is neither the new side nor the stored one, so an operator that returns either fails its check."""
    found = canonical_queries.all_findings(spark, sf_dir)
    got = rows(QUERIES["findings_upsert"](spark, sf_dir), "finding_id", "resolution_status")
    assert got != rows(found, "finding_id", "resolution_status")
    assert {s for _, s in got} == {"accepted", "open"} and len(got) > found.count()
    edges = QUERIES["edges_upsert"](spark, sf_dir)
    assert edges.where("from_sop LIKE 'gone.%'").count() > 0
    old = rows(graph_queries.old_resolved(spark, sf_dir), "from_sop", "status")
    assert rows(edges.where("from_sop NOT LIKE 'gone.%'"), "from_sop", "status") not in (old, rows(graph_queries.resolved(spark, sf_dir), "from_sop", "status"))
    merged = QUERIES["projection_merge"](spark, sf_dir)
    assert {r["modality"] for r in merged.select("modality").distinct().collect()} == {"held", "fresh"}
    assert merged.count() > model_queries.new_model(spark, sf_dir).count()


def test_every_invariant_is_broken_in_its_query(spark, sf_dir):
    rules = {r["rule"] for r in QUERIES["ledger_invariants"](spark, sf_dir).select("rule").distinct().collect()}
    assert len(rules) >= 12 and {"canonical_of_other_instance", "instance_without_series", "idempotency_key_not_unique"} <= rules


COMPAT = [("1.0.0", "compatible", "ok"), ("2.0.0", "incompatible", "Major " + "x" * 400)]


def test_marking_twice_is_marking_once(spark):
    compat = spark.createDataFrame(COMPAT, "old_version string, level string, reason string")
    series = spark.createDataFrame(
        [("a", "1.0.0", "current"), ("b", "2.0.0", "current"), ("c", "2.0.0", "stale"), ("d", "9.9", "current"), ("e", None, "current"), ("f", "2.0.0", "reparse_failed")],
        "series_instance_uid string, extracted_schema_version string, projection_status string",
    ).withColumn("stale_reason", F.when(F.col("projection_status") != "current", "before")).withColumn("needs_reparse", F.col("projection_status") != "current")
    once = E.stale_by_version(series, compat)
    want = [
        ("a", "current", None, False, "compatible"),
        ("b", "stale", COMPAT[1][2], True, "incompatible"),
        ("c", "stale", "before", True, "incompatible"),
        ("d", "stale", "Schema definition not found for 9.9", True, "unknown"),
        ("e", "stale", "Schema definition not found for no version", True, "unknown"),
        ("f", "reparse_failed", "before", True, "incompatible"),
    ]
    columns = ["series_instance_uid", "projection_status", "stale_reason", "needs_reparse", "level"]
    assert rows(once, *columns) == want and rows(E.stale_by_version(once, compat), *columns) == want


def test_lists_are_whole_unless_asked(spark):
    errors = spark.range(400).select(F.col("id").alias("item_id"), F.lit("j").alias("job_id"), F.concat(F.lit("e"), "id").alias("error_code"))
    assert R.job_errors(errors).count() == 400 and R.job_errors(errors, 5).count() == 5
    findings = errors.select(F.col("item_id").alias("finding_id"), F.current_date().alias("observed_at"))
    assert R.findings_view(findings).count() == 400 and R.findings_view(findings, limit=7).count() == 7
