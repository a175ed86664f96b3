"""Queries over items, jobs, review views, reports and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators import lifecycle as L
from obsledger.operators import replay as P
from obsledger.operators import review as R
from obsledger.plans import fixtures as X
from obsledger.plans.canonical_queries import FLAGGED, pixel_findings
from obsledger.plans.graph_queries import CONFLICT, summaries
from obsledger.operators.conflicts import conflict_queue
from obsledger.plans.registry import query
from obsledger.session import staged

AS_OF = "2024-01-02 06:00:00"


def as_of():
    return F.expr(f"timestamp_ntz'{AS_OF}'")


AXES = ", ".join(V.AXES)
ALL_DONE = "(" + " AND ".join(f"{a} = 'completed'" for a in V.AXES) + ")"
ANY_FAILED = "(" + " OR ".join(f"{a} = 'failed'" for a in V.AXES) + ")"
REVIEW_STATUS = f"""CASE WHEN outcome = 'quarantined' THEN 'quarantined' WHEN outcome = 'rejected' THEN 'rejected'
  WHEN outcome = 'accepted' THEN 'approved' WHEN outcome = 'failed' OR {ANY_FAILED} THEN 'needs_attention' ELSE 'pending_review' END"""

# --- identity and lifecycle --------------------------------------------------------------


@query("item_fingerprint", """
SELECT sha256(job_id || ':' || CASE item_id % 2 WHEN 0 THEN 'local_folder' ELSE 'curated_manifest' END || ':' || source_path || ':' || byte_size) AS item_fingerprint, item_id FROM v_item""")
def item_fingerprint(spark, sf):
    items = X.items(spark, sf).withColumn("source_kind", X.pick(F.col("item_id") % 2, ["local_folder", "curated_manifest"]))
    return L.fingerprint_items(items.unionByName(items.withColumn("item_id", F.col("item_id") + 1_000_000_000)))


@query("job_idempotency", """
SELECT request_id, actor_id, idempotency_key, body,
       CASE WHEN idempotency_key IS NULL THEN request_id ELSE first_id END AS job_request_id,
       CASE WHEN idempotency_key IS NULL OR request_id = first_id THEN 'accepted' WHEN body = first_body THEN 'replayed' ELSE 'conflict' END AS verdict
FROM (SELECT *, first_value(request_id) OVER w AS first_id, first_value(body) OVER w AS first_body
      FROM (SELECT event_id AS request_id, job_id AS actor_id, CASE WHEN event_type <> 'view' THEN 'k' || (item_id % 20) END AS idempotency_key,
                   event_type AS body, ts FROM v_event)
      WINDOW w AS (PARTITION BY actor_id, idempotency_key ORDER BY ts, request_id))""")
def job_idempotency(spark, sf):
    requests = X.events(spark, sf).select(
        F.col("event_id").alias("request_id"), F.col("job_id").alias("actor_id"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("k"), (F.col("item_id") % 20).cast("string"))).alias("idempotency_key"),
        F.col("event_type").alias("body"), F.col("ts").alias("requested_at"),
    )
    return L.job_idempotency(requests).drop("requested_at")


@query("status_fold", f"""
SELECT item_id, {", ".join(f"coalesce(arg_max(status, struct_pack(a := ts, b := event_id)) FILTER (WHERE axis = '{a}'), 'pending') AS {a}" for a in V.AXES)},
       arg_max(error_code, struct_pack(a := ts, b := event_id)) FILTER (WHERE status = 'failed') AS error_code,
       arg_max(stage, struct_pack(a := ts, b := event_id)) FILTER (WHERE status = 'failed') AS last_retryable_stage
FROM v_event GROUP BY item_id""")
def status_fold(spark, sf):
    return L.status_fold(X.events(spark, sf))


FACTS = {
    "v_fact": """SELECT doc_id AS item_id, CASE WHEN doc_id % 17 = 0 THEN 'mask, label' END AS missing_annotations, doc_id % 13 <> 0 AS readable,
        n_chars > 200 AS looks_like_image, CASE WHEN lang = 'de' THEN 'bad header in ' || source END AS parse_error,
        CASE WHEN lang = 'es' THEN 'modality' END AS missing_tags, CASE WHEN source = 'src7' THEN 'disk full' END AS storage_error FROM documents""",
}


@query("terminal_outcome", f"""
SELECT item_id, CASE WHEN rule < 6 THEN 'rejected' WHEN rule = 6 THEN 'failed' ELSE 'accepted' END AS outcome,
       ['{V.MISSING_ANNOTATION}', '{V.UNREADABLE}', '{V.NOT_IMAGE}', '{V.PARSE_FAILED}', '{V.MISSING_TAG}', '{V.STORAGE_FAILED}', ''][rule] AS error_code,
       CASE rule WHEN 1 THEN missing_annotations WHEN 3 THEN 'DICOM magic not found at byte offset 128' WHEN 4 THEN parse_error
         WHEN 5 THEN 'Missing required tags: ' || missing_tags WHEN 6 THEN storage_error ELSE '' END AS error_detail
FROM (SELECT *, CASE WHEN missing_annotations IS NOT NULL THEN 1 WHEN NOT readable THEN 2 WHEN NOT looks_like_image THEN 3
        WHEN parse_error IS NOT NULL THEN 4 WHEN missing_tags IS NOT NULL THEN 5 WHEN storage_error IS NOT NULL THEN 6 ELSE 7 END AS rule FROM v_fact)""", FACTS)
def terminal_outcome(spark, sf):
    doc = F.col("doc_id")
    facts = X.table(spark, sf, "documents").select(
        doc.alias("item_id"),
        F.when(doc % 17 == 0, "mask, label").alias("missing_annotations"),
        (doc % 13 != 0).alias("readable"),
        (F.col("n_chars") > 200).alias("looks_like_image"),
        F.when(F.col("lang") == "de", F.concat(F.lit("bad header in "), "source")).alias("parse_error"),
        F.when(F.col("lang") == "es", "modality").alias("missing_tags"),
        F.when(F.col("source") == "src7", "disk full").alias("storage_error"),
    )
    return L.terminal_outcome(facts).select("item_id", "outcome", "error_code", "error_detail")


@query("outcome_conflicts", """
SELECT item_id, first_outcome, outcome AS refused_outcome, count(*) AS attempts
FROM (SELECT *, first_value(outcome) OVER (PARTITION BY item_id ORDER BY ts, event_id) AS first_outcome FROM v_event WHERE outcome IS NOT NULL)
WHERE outcome <> first_outcome GROUP BY ALL""")
def outcome_conflicts(spark, sf):
    return L.outcome_conflicts(X.events(spark, sf))


@query("close_axes", f"""
SELECT item_id, scan_status, {", ".join(f"CASE WHEN outcome = 'rejected' AND {a} = 'pending' THEN 'rejected' ELSE {a} END AS {a}" for a in V.AXES[1:])}
FROM (SELECT * REPLACE (CASE WHEN item_id % 2 = 0 THEN 'pending' ELSE index_status END AS index_status) FROM v_item)""")
def close_axes(spark, sf):
    items = X.items(spark, sf).withColumn(
        "index_status", F.when(F.col("item_id") % 2 == 0, "pending").otherwise(F.col("index_status"))
    )
    return L.close_axes(items).select("item_id", *V.AXES)


@query("item_flags", f"""
SELECT item_id, {ALL_DONE} AS all_completed, {ANY_FAILED} AS any_failed,
       CASE WHEN outcome = 'failed' THEN coalesce(last_retryable_stage, '') <> '' WHEN outcome IS NOT NULL THEN false ELSE {ANY_FAILED} END AS can_retry
FROM v_item""")
def item_flags(spark, sf):
    return L.item_flags(X.items(spark, sf)).select("item_id", "all_completed", "any_failed", "can_retry")


STATE_OF = {"signup": "receiving", "view": "scanning", "click": "processing", "purchase": "completed", "error": "failed"}


@query("transition_check", f"""
SELECT job_id, event_id, from_state, state AS to_state
FROM (SELECT *, coalesce(lag(state) OVER (PARTITION BY job_id ORDER BY ts, event_id), 'created') AS from_state
      FROM (SELECT *, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_OF.items())} END AS state FROM v_event))
WHERE from_state <> state AND NOT ({" OR ".join(f"(from_state = '{k}' AND state IN ({', '.join(repr(t) for t in v)}))" for k, v in V.JOB_TRANSITIONS.items() if v)})""")
def transition_check(spark, sf):
    state = F.create_map(*[F.lit(x) for pair in STATE_OF.items() for x in pair])[F.col("event_type")]
    return L.transition_check(X.events(spark, sf).withColumn("state", state))


@query("accept_items", """
SELECT observation_id AS item_id, series_instance_uid AS attempt_id, job_id, CASE WHEN same THEN 'accepted' END AS outcome,
       CASE WHEN NOT same THEN 'AttemptOfOtherJob' END AS error_code
FROM (SELECT o.*, EXISTS (SELECT 1 FROM orders WHERE o_orderkey = o.l_orderkey AND year(o_orderdate) = o.job_id) AS same FROM v_obs o)""")
def accept_items(spark, sf):
    items = X.observations(spark, sf).select(
        F.col("observation_id").alias("item_id"), F.col("series_instance_uid").alias("attempt_id"), "job_id"
    )
    attempts = X.table(spark, sf, "orders").select(
        F.concat(F.lit("1.2.826."), F.col("o_orderkey").cast("string")).alias("attempt_id"), F.year("o_orderdate").alias("job_id")
    )
    return L.accept_items(items, attempts)


@query("item_status", f"""
SELECT item_id, CASE WHEN outcome IS NOT NULL THEN outcome WHEN {ALL_DONE} THEN 'completed' WHEN {ANY_FAILED} THEN 'failed' ELSE 'in_progress' END AS status
FROM v_item""")
def item_status(spark, sf):
    return X.items(spark, sf).select("item_id", L.item_status().alias("status"))


# --- review ------------------------------------------------------------------------------


def _unpivot(columns: str, source: str) -> str:
    return f"SELECT metric, value FROM (UNPIVOT (SELECT {columns} FROM {source}) ON COLUMNS(*) INTO NAME metric VALUE value)"


def _n(condition: str, name: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS {name}"


SUMMARY_SQL = (
    _unpivot(
        ", ".join([
            "count(*) AS total_jobs", _n("status NOT IN ('completed', 'failed', 'cancelled')", "active_jobs"),
            _n("status = 'completed'", "completed_jobs"), _n("status = 'failed'", "failed_jobs"),
            _n(f"created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR", "jobs_last_24h"),
        ]), "v_job")
    + " UNION ALL "
    + _unpivot(
        ", ".join([
            "count(*) AS total_items", *[_n(f"outcome = '{o}'", f"{o}_items") for o in V.OUTCOMES],
            _n("outcome IS NULL", "items_pending_review"),
            _n(f"created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR", "items_last_24h"),
            "count(DISTINCT job_id) FILTER (WHERE outcome = 'failed') AS jobs_with_failures",
        ]), "v_item")
)


@query("ingestion_summary", SUMMARY_SQL)
def ingestion_summary(spark, sf):
    return R.ingestion_summary(X.jobs(spark, sf), X.items(spark, sf), as_of())


JOB_REVIEW = {
    "v_job_review": f"""SELECT job_id, actor_id, source_type, status, status IN ('completed', 'failed', 'cancelled') AS is_terminal,
          CAST(floor(epoch(finished_at) - epoch(j.created_at)) AS BIGINT) AS duration_seconds, count(*) AS total_items,
          {_n("outcome = 'accepted'", "completed_items")}, {_n("outcome = 'failed'", "failed_items")},
          {_n("outcome = 'quarantined'", "quarantined_items")}, {_n("outcome IS NULL", "pending_items")},
          {_n("outcome IS NULL OR outcome IN ('failed', 'quarantined')", "items_needing_review")}
        FROM v_job j JOIN v_item USING (job_id) GROUP BY job_id, actor_id, source_type, status, finished_at, j.created_at""",
}


@query("job_review", "SELECT * FROM v_job_review", JOB_REVIEW)
def job_review(spark, sf):
    return R.job_review(X.jobs(spark, sf), X.items(spark, sf))


@query("job_review_items", "SELECT job_id, item_id, outcome FROM v_item WHERE outcome IS NULL OR outcome IN ('failed', 'quarantined')")
def job_review_items(spark, sf):
    return R.job_review_items(X.items(spark, sf))


@query("job_errors", """
SELECT job_id, error_code, n, CAST(position AS INTEGER) AS position FROM (
  SELECT job_id, error_code, count(*) AS n, row_number() OVER (PARTITION BY job_id ORDER BY count(*) DESC, error_code) AS position
  FROM v_item WHERE coalesce(error_code, '') <> '' GROUP BY job_id, error_code) WHERE position <= 5""")
def job_errors(spark, sf):
    return R.job_errors(X.items(spark, sf), 5)


@query("item_review", f"""
SELECT i.item_id, job_id, source_path, byte_size, outcome, {ALL_DONE} AS is_complete, {ANY_FAILED} AS has_failures,
       CASE WHEN coalesce(error_code, '') <> '' THEN error_code || ': ' || coalesce(error_detail, 'No details') END AS error_summary,
       CASE WHEN i.outcome = 'rejected' THEN NULL WHEN d.item_id IS NOT NULL THEN 'content (whole_file_sha256)' ELSE 'no_duplicates_found' END AS duplicate_status,
       coalesce(outcome, '') <> 'rejected' AND lang IN ('de', 'es') AS private_tags_persisted,
       CASE WHEN i.outcome = 'rejected' THEN 0 ELSE coalesce(r.n, 0) END AS references_extracted,
       CASE WHEN i.outcome = 'rejected' THEN NULL ELSE coalesce(b.status, 'unbound') END AS review_binding_status,
       {REVIEW_STATUS} AS review_status
FROM v_item i
LEFT JOIN (SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY whole_file_sha256 ORDER BY CAST(created_at AS DATE), item_id) AS rn FROM v_item) WHERE rn > 1) d ON d.item_id = i.item_id
LEFT JOIN (SELECT conv_id AS k, count(*) AS n FROM conversations GROUP BY 1) r ON r.k = i.item_id % 300
LEFT JOIN (SELECT doc_id AS k, CASE WHEN toxic = 1 THEN 'failed' ELSE 'bound' END AS status FROM labels) b ON b.k = i.item_id % 300""")
def item_review(spark, sf):
    from obsledger.operators.duplicates import content_duplicates

    items = X.items(spark, sf)
    sop = F.concat(F.lit("s"), (F.col("item_id") % 300).cast("string"))
    observations = items.where("outcome IS NULL OR outcome <> 'rejected'").select(
        "item_id", F.col("item_id").alias("observation_id"), sop.alias("sop_instance_uid")
    )
    hashed = items.select(
        F.col("item_id").alias("observation_id"), F.col("created_at").cast("date").alias("observed_at"), "whole_file_sha256"
    )
    labels = X.table(spark, sf, "labels")
    return R.item_review(
        items,
        observations,
        content_duplicates(hashed, "whole_file_sha256"),
        items.where("lang IN ('de', 'es')").select(F.col("item_id").alias("observation_id")),
        X.table(spark, sf, "conversations").select(F.concat(F.lit("s"), F.col("conv_id").cast("string")).alias("from_sop")),
        labels.select(
            F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("sop_instance_uid"),
            F.when(F.col("toxic") == 1, "failed").when(F.col("quality") == 1, "bound").alias("binding_status"),
        ),
    )


@query("review_status", f"SELECT item_id, {REVIEW_STATUS} AS review_status FROM v_item")
def review_status(spark, sf):
    return X.items(spark, sf).select("item_id", R.review_status().alias("review_status"))


@query("items_for_review", f"""
SELECT item_id, job_id, review_status FROM (SELECT *, {REVIEW_STATUS} AS review_status FROM v_item) WHERE review_status = 'needs_attention'
ORDER BY item_id LIMIT 50 OFFSET 50""")
def items_for_review(spark, sf):
    page = R.items_for_review(X.items(spark, sf), status="needs_attention", page=2, per_page=50)
    return page.select("item_id", "job_id", "review_status")


@query("findings_view", """
SELECT finding_id, observation_id, matched_observation_id, observed_at FROM v_finding WHERE duplicate_type = 'content'
ORDER BY observed_at DESC, finding_id LIMIT 100""", FLAGGED, dates=["observed_at"])
def findings_view(spark, sf):
    newest = R.findings_view(pixel_findings(spark, sf), "content", limit=100)
    return newest.select("finding_id", "observation_id", "matched_observation_id", "observed_at")


@query("review_report", f"""
SELECT 'summary' AS section, metric AS subject, CAST(value AS VARCHAR) AS detail FROM ({SUMMARY_SQL})
UNION ALL SELECT 'job', job_id, concat_ws('/', status, CAST(total_items AS VARCHAR), CAST(items_needing_review AS VARCHAR))
  FROM (SELECT r.* FROM v_job_review r)
UNION ALL SELECT * FROM (SELECT 'item', CAST(item_id AS VARCHAR), coalesce(error_code, '') FROM v_item WHERE {REVIEW_STATUS} = 'needs_attention')
UNION ALL SELECT 'conflict', series_instance_uid, classification FROM v_conflict WHERE status = 'open'
UNION ALL SELECT 'duplicate', finding_id, duplicate_type FROM v_finding WHERE duplicate_type = 'content'""",
{**JOB_REVIEW, **CONFLICT, **FLAGGED})
def review_report(spark, sf):
    """Conflicts and findings are written first, one after the other."""
    conflicts = staged(conflict_queue(summaries(spark, sf)), "conflicts")
    findings = staged(pixel_findings(spark, sf), "findings")
    return R.review_report(X.jobs(spark, sf), X.items(spark, sf), conflicts, findings, as_of())


# --- reports -----------------------------------------------------------------------------

COUNTS = ", ".join(["count(item_id) AS total_items", *[_n(f"outcome = '{o}'", f"{o}_count") for o in V.OUTCOMES]])


@query("terminal_report", f"""
SELECT c.*, coalesce(d.n, 0) AS duplicate_findings, coalesce(u.n, 0) AS unresolved_references,
       CASE WHEN total_items = 0 THEN 'failure' WHEN accepted_count = total_items THEN 'success' WHEN accepted_count > 0 THEN 'partial' ELSE 'failure' END AS classification
FROM (SELECT j.job_id, {COUNTS} FROM (SELECT job_id FROM v_job UNION ALL SELECT 'empty-' || n_name FROM nation) j LEFT JOIN v_item USING (job_id) GROUP BY j.job_id) c
LEFT JOIN (SELECT job_id, count(*) AS n FROM (SELECT job_id, row_number() OVER (PARTITION BY whole_file_sha256 ORDER BY CAST(created_at AS DATE), item_id) AS rn FROM v_item)
           WHERE rn > 1 GROUP BY 1) d USING (job_id)
LEFT JOIN (SELECT 'src' || (page_id % 15) AS job_id, count(*) AS n FROM pages GROUP BY 1) u USING (job_id)""")
def terminal_report(spark, sf):
    from obsledger.operators.duplicates import content_duplicates

    items = X.items(spark, sf)
    empty = X.table(spark, sf, "nation").select(F.concat(F.lit("empty-"), "n_name").alias("job_id"))
    hashed = items.select(
        F.col("item_id").alias("observation_id"), F.col("created_at").cast("date").alias("observed_at"), "whole_file_sha256"
    )
    found = content_duplicates(hashed, "whole_file_sha256").select(F.col("observation_id").alias("item_id"))
    duplicates = items.join(found, "item_id", "left_semi").groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))
    unresolved = (
        X.table(spark, sf, "pages")
        .groupBy(F.concat(F.lit("src"), (F.col("page_id") % 15).cast("string")).alias("job_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return R.terminal_report(X.jobs(spark, sf).select("job_id").unionByName(empty), items, duplicates, unresolved)


@query("terminal_items", """
SELECT job_id, item_id, source_path, outcome, error_code, error_detail, binding_status, index_status FROM v_item WHERE outcome = 'rejected'""")
def terminal_items(spark, sf):
    return R.terminal_items(X.items(spark, sf), "rejected")


@query("failure_summary", """
SELECT job_id, CASE WHEN coalesce(error_code, '') = '' THEN 'UNKNOWN' ELSE error_code END AS error_code, count(*) AS n
FROM v_item WHERE outcome IN ('failed', 'rejected') GROUP BY ALL""")
def failure_summary(spark, sf):
    return R.failure_summary(X.items(spark, sf))


@query("progress_report", f"""
SELECT job_id, CASE {" ".join(f"WHEN {a} <> 'completed' THEN '{s}'" for a, s in zip(V.AXES, V.REPLAY_STAGES))} ELSE 'done' END AS stage,
       count(*) AS total_items, 'in_progress' AS classification, false AS report_ready
FROM v_item WHERE outcome IS NULL GROUP BY ALL""")
def progress_report(spark, sf):
    return R.progress_report(X.items(spark, sf))


@query("report_invariant", """
SELECT job_id, count(*) AS total_items, count(outcome) AS items_with_outcome, CASE WHEN count(*) = count(outcome) THEN 'ok' ELSE 'broken' END AS verdict
FROM v_item WHERE job_id IN (SELECT job_id FROM v_job WHERE status = 'completed') GROUP BY job_id""")
def report_invariant(spark, sf):
    return R.report_invariant(X.jobs(spark, sf), X.items(spark, sf))


@query("orphaned_objects", """
SELECT 'local-nas://default/' || source_path AS storage_uri, item_id FROM v_item
WHERE 'local-nas://default/' || source_path NOT IN (SELECT storage_uri FROM v_item WHERE storage_uri IS NOT NULL)""")
def orphaned_objects(spark, sf):
    items = X.items(spark, sf)
    objects = items.select(F.concat(F.lit("local-nas://default/"), "source_path").alias("storage_uri"), "item_id")
    return R.orphaned_objects(objects, items)


SOURCE_ERRORS = {
    "v_source_error": """SELECT 'src' || (page_id % 22) AS job_id,
        CASE WHEN page_id % 3 = 0 THEN '/mnt/upload/' || page_id || '.dcm' WHEN page_id % 3 = 1 THEN 'rel/' || page_id END AS path,
        CASE WHEN page_id % 4 > 0 THEN 'FileTooLarge' END AS error_code,
        CASE WHEN page_id % 5 = 0 THEN 'cannot read: /mnt/upload/x: y' WHEN page_id % 5 = 1 THEN 'size: 12: /etc' ELSE 'plain ' || url END AS error_detail
        FROM pages""",
}


def source_errors(spark, sf):
    page = F.col("page_id")
    return X.table(spark, sf, "pages").select(
        F.concat(F.lit("src"), (page % 22).cast("string")).alias("job_id"),
        F.when(page % 3 == 0, F.concat(F.lit("/mnt/upload/"), page.cast("string"), F.lit(".dcm")))
        .when(page % 3 == 1, F.concat(F.lit("rel/"), page.cast("string"))).alias("path"),
        F.when(page % 4 > 0, "FileTooLarge").alias("error_code"),
        F.when(page % 5 == 0, "cannot read: /mnt/upload/x: y").when(page % 5 == 1, "size: 12: /etc")
        .otherwise(F.concat(F.lit("plain "), "url")).alias("error_detail"),
    )


@query("ingest_report", f"""
SELECT job_id, coalesce(total_items, 0) AS total_items, coalesce(accepted, 0) AS accepted_instances,
       coalesce(rejected, 0) + coalesce(errors, 0) AS rejected_items, coalesce(failed, 0) AS failed_items, coalesce(errors, 0) AS warnings,
       coalesce(stored, 0) AS stored_items, coalesce(nas, 0) AS local_nas, coalesce(obj, 0) AS object
FROM (SELECT job_id, count(*) AS total_items, {_n("outcome = 'accepted'", "accepted")}, {_n("outcome = 'rejected'", "rejected")}, {_n("outcome = 'failed'", "failed")},
        {_n("outcome = 'accepted' AND storage_uri IS NOT NULL", "stored")}, {_n("outcome = 'accepted' AND storage_uri LIKE 'local-nas://%'", "nas")},
        {_n("outcome = 'accepted' AND storage_uri LIKE 's3://%'", "obj")} FROM v_item GROUP BY job_id)
FULL JOIN (SELECT job_id, count(*) AS errors FROM v_source_error GROUP BY job_id) USING (job_id)""", SOURCE_ERRORS)
def ingest_report(spark, sf):
    return R.ingest_report(X.items(spark, sf), source_errors(spark, sf))


@query("report_sanitize", """
SELECT job_id, source_path AS relative_path, error_code AS reason, error_detail AS detail FROM v_item WHERE outcome = 'rejected'
UNION ALL SELECT job_id, CASE WHEN path LIKE '/%' THEN string_split(path, '/')[-1] ELSE coalesce(path, '') END, coalesce(error_code, 'SourceError'),
  CASE WHEN strpos(error_detail, ': ') > 0 AND substr(error_detail, strpos(error_detail, ': ') + 2, 1) = '/'
       THEN substr(error_detail, 1, strpos(error_detail, ': ') - 1) ELSE error_detail END
FROM v_source_error""", SOURCE_ERRORS)
def report_sanitize(spark, sf):
    return R.rejections(X.items(spark, sf), source_errors(spark, sf))


@query("fallback_counts", """
SELECT field, fallback, count(*) AS n FROM (
  SELECT 'ManufacturerModelName' AS field, "ManufacturerModelName" AS fallback FROM v_tags UNION ALL SELECT 'StudyTime', "StudyTime" FROM v_tags
  UNION ALL SELECT 'vendor', CASE WHEN "Manufacturer" LIKE 'Acme%' THEN 'UNKNOWN_VENDOR' WHEN "Manufacturer" = '联影' THEN 'UNKNOWN' END FROM v_tags)
WHERE fallback IN ('UNKNOWN', 'UNKNOWN_VENDOR', 'UNKNOWN_DEVICE', 'GENERIC', 'NO_MEAS_UID') GROUP BY ALL""")
def fallback_counts(spark, sf):
    tags = X.tags(spark, sf).withColumn(
        "vendor",
        F.when(F.col("Manufacturer").startswith("Acme"), "UNKNOWN_VENDOR").when(F.col("Manufacturer") == "联影", "UNKNOWN"),
    )
    return R.fallback_counts(tags, X.tag_map(tags))


@query("annotation_summary", """
SELECT 'referenced_items' AS metric, count(*) AS value FROM conversations WHERE conv_id IN (SELECT item_id FROM v_item)
UNION ALL SELECT 'items_with_annotations', count(DISTINCT conv_id) FROM conversations WHERE conv_id IN (SELECT item_id FROM v_item)
UNION ALL SELECT 'items_missing_required_annotations', count(*) FROM v_item WHERE error_code = 'DicomParseFailed'
UNION ALL SELECT 'task_type:' || role, count(*) FROM conversations WHERE role <> 'system' GROUP BY role""")
def annotation_summary(spark, sf):
    items = X.items(spark, sf).withColumn(
        "error_code", F.when(F.col("error_code") == V.PARSE_FAILED, V.MISSING_ANNOTATION).otherwise(F.col("error_code"))
    )
    refs = X.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("item_id"), F.when(F.col("role") != "system", F.col("role")).alias("task_type")
    )
    return R.annotation_summary(items, refs)


# --- replay ------------------------------------------------------------------------------

ELIGIBLE = f"coalesce(storage_uri, '') <> '' AND (coalesce(outcome, '') = 'failed' OR coalesce(last_retryable_stage, '') <> '' OR {ANY_FAILED})"


@query("replay_eligible", f"SELECT item_id, {ELIGIBLE} AS eligible, coalesce(storage_uri, '') <> '' AS eligible_forced FROM v_item")
def replay_eligible(spark, sf):
    return X.items(spark, sf).select(
        "item_id", P.replay_eligible().alias("eligible"), P.replay_eligible(force=True).alias("eligible_forced")
    )


@query("replay_plan", " UNION ALL ".join(
    f"SELECT item_id, {i + 1} AS stage_no, '{stage}' AS stage, {axis} AS axis_status, {axis} IN ('failed', 'pending', 'awaiting_retry') AS attempted "
    f"FROM v_item WHERE {ELIGIBLE}"
    for i, (stage, axis) in enumerate(zip(V.REPLAY_STAGES, V.AXES)) if i >= 1
))
def replay_plan(spark, sf):
    return P.replay_plan(X.items(spark, sf), from_stage="parse")


@query("retry_select", """
SELECT item_id, job_id, storage_uri FROM v_item WHERE storage_uri IS NOT NULL AND (outcome = 'failed' OR last_retryable_stage IS NOT NULL
  OR parse_status = 'failed' OR storage_status = 'failed' OR metadata_persistence_status = 'failed') ORDER BY item_id LIMIT 100""")
def retry_select(spark, sf):
    return P.retry_select(X.items(spark, sf), max_items=100).select("item_id", "job_id", "storage_uri")


def replays(spark, sf):
    return X.events(spark, sf).where("status IN ('completed', 'failed')").select(
        "job_id", "item_id", "event_id", F.col("ts").alias("replayed_at"), "stage", "duration_ms",
        (F.col("status") == "completed").alias("success"), "error_code",
    )


@query("retry_summary", f"""
SELECT job_id, count(*) AS total_items, {_n("status = 'completed'", "succeeded")}, {_n("status = 'failed'", "failed")},
       {_n("status = 'failed' AND error_code IS NOT NULL", "errors")}, count(*) FILTER (WHERE status = 'failed') = 0 AS success, false AS dry_run
FROM v_event WHERE status IN ('completed', 'failed') GROUP BY job_id""")
def retry_summary(spark, sf):
    return P.retry_summary(replays(spark, sf))


@query("replay_history", """
SELECT item_id, event_id, stage, status = 'completed' AS success, row_number() OVER (PARTITION BY item_id ORDER BY ts, event_id) AS replay_no
FROM v_event WHERE status IN ('completed', 'failed')""")
def replay_history(spark, sf):
    return P.replay_history(replays(spark, sf)).select("item_id", "event_id", "stage", "success", "replay_no")
