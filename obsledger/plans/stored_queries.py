"""Queries over stored tables: what a page, a merge or a rebuild leaves, checked like the operators they stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators import stored as S
from obsledger.operators.references import EDGE
from obsledger.plans import canonical_queries, graph_queries, model_queries
from obsledger.plans.registry import ORACLES, query
from obsledger.session import run_folder, staged

PAGE_AFTER = "3"  # any text is a cursor


@query("stored_projection_page", f"""
SELECT instance_id, sop_instance_uid, study_date FROM v_projection WHERE {model_queries.FILTERED} AND instance_id > '{PAGE_AFTER}' ORDER BY instance_id LIMIT 100""", model_queries.MODEL, dates=["study_date"])
def stored_projection_page(spark, sf):
    table = S.open_table(spark, run_folder(spark, "read-model"), "projections", 16)
    table.create(S.with_year(model_queries.projections(spark, sf)))
    return S.stored_page(table, 100, PAGE_AFTER, **model_queries.filters()).select("instance_id", "sop_instance_uid", "study_date")


def stored_model(spark, held, buckets: int = 16):
    """The read model as held, with rows that are not built any more, as a stored table."""
    held = held.withColumn("modality", F.lit("held"))
    held = held.unionByName(held.withColumn("instance_id", F.md5(F.concat(F.lit("gone"), "instance_id"))))
    return S.open_table(spark, run_folder(spark, "read-model"), "projections", buckets).create(S.with_year(held))


@query("stored_projection_merge")
def stored_projection_merge(spark, sf):
    """The batch is merged twice: the second time changes nothing."""
    new = staged(model_queries.new_model(spark, sf), "read-model")
    table, fresh = stored_model(spark, model_queries.held_of(new)), new.withColumn("modality", F.lit("fresh"))
    S.merge_projections(table, fresh)
    S.merge_projections(table, fresh)
    return table.read().select(
        "instance_id", "study_instance_uid", "series_instance_uid", "sop_instance_uid", "modality", "projection_version", "projection_source_checksum"
    )


@query("stored_findings_merge", dates=["observed_at"])
def stored_findings_merge(spark, sf):
    found = canonical_queries.all_findings(spark, sf)
    settled = found.where("duplicate_type = 'identity'").withColumn("resolution_status", F.lit("accepted"))
    table = S.open_table(spark, run_folder(spark, "findings"), "findings", 16)
    table.create(settled.unionByName(settled.withColumn("finding_id", F.md5("finding_id"))))
    S.merge_findings(table, found.unionByName(found))
    return table.read()


@query("stored_edges_merge")
def stored_edges_merge(spark, sf):
    old = staged(graph_queries.old_resolved(spark, sf).select(*EDGE, "status", "resolved_sop"), "edges")
    table = S.open_table(spark, run_folder(spark, "edges"), "edges", 16)
    table.create(S.edges_with_key(old.unionByName(old.withColumn("from_sop", F.concat(F.lit("gone."), "from_sop")))))
    S.merge_edges(table, staged(graph_queries.resolved(spark, sf).where("relationship = 'waveform'"), "edges"))
    return table.read()


@query("reindex_stored", f"""
SELECT CASE WHEN s.observed_at BETWEEN DATE '1996-06-01' AND DATE '2000-06-30' THEN '{V.PROJECTION_VERSION}' ELSE h.projection_version END AS projection_version,
  CASE WHEN s.observed_at BETWEEN DATE '1996-06-01' AND DATE '2000-06-30' THEN 'fresh' ELSE 'held' END AS modality, count(*) AS n
FROM v_state s LEFT JOIN v_held h USING (instance_id) WHERE s.state <> 'missing' OR s.observed_at BETWEEN DATE '1996-06-01' AND DATE '2000-06-30' GROUP BY ALL""", model_queries.STORED_MODEL)
def reindex_stored(spark, sf):
    """The read model after a rebuild of the instances in scope, by version and side."""
    held = model_queries.held_model(spark, sf).withColumn("modality", F.lit("held"))
    table = S.open_table(spark, run_folder(spark, "read-model"), "projections", 16).create(S.with_year(held))
    fresh = model_queries.new_model(spark, sf).withColumn("modality", F.lit("fresh"))
    S.rebuild_stored(table, "rebuild", model_queries.canonical_instances(spark, sf), fresh, model_queries.SCOPE)
    return table.read().groupBy("projection_version", "modality").agg(F.count(F.lit(1)).alias("n"))


for _name, _same in (("stored_projection_merge", "projection_merge"), ("stored_findings_merge", "findings_upsert"), ("stored_edges_merge", "edges_upsert")):
    ORACLES[_name] = ORACLES[_same]
