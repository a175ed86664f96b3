"""Queries over references, series conflicts and bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.keys import natural_key
from obsledger.operators import binding as B
from obsledger.operators import canonical as C
from obsledger.operators import conflicts as K
from obsledger.operators import references as R
from obsledger.plans import fixtures as X
from obsledger.plans.canonical_queries import FLAGGED, LAST_STORED_JOB
from obsledger.plans.registry import query
from obsledger.session import staged

# --- references --------------------------------------------------------------------------

RESOLVE = """SELECT e.*, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status,
    CASE WHEN n = 1 THEN target END AS resolved_sop, resolution_path, n AS candidate_count
  FROM (SELECT b.*, CASE WHEN s.sop_instance_uid IS NOT NULL THEN 1 WHEN r.n > 0 THEN r.n WHEN t.n > 0 THEN t.n ELSE 0 END AS n,
               CASE WHEN s.sop_instance_uid IS NOT NULL THEN to_sop WHEN r.n > 0 THEN r.first WHEN t.n > 0 THEN t.first END AS target,
               CASE WHEN s.sop_instance_uid IS NOT NULL THEN 'sop_instance_uid' WHEN r.n > 0 THEN 'series_instance_uid'
                    WHEN t.n > 0 THEN 'study_instance_uid' END AS resolution_path
        FROM {edges} b LEFT JOIN {inst} s ON s.sop_instance_uid = to_sop
        LEFT JOIN (SELECT series_instance_uid, count(*) AS n, min(sop_instance_uid) AS first FROM {inst} GROUP BY 1) r ON r.series_instance_uid = to_series
        LEFT JOIN (SELECT study_instance_uid, count(*) AS n, min(sop_instance_uid) AS first FROM {inst} GROUP BY 1) t ON t.study_instance_uid = to_study) e"""

GRAPH = {
    "v_resolved": RESOLVE.format(edges="v_edge", inst="v_inst").replace("SELECT e.*", "SELECT e.* EXCLUDE (n, target, resolution_path)"),
    "v_old_inst": f"SELECT DISTINCT sop_instance_uid, series_instance_uid, study_instance_uid FROM v_obs WHERE job_id <= {LAST_STORED_JOB}",
    "v_old_resolved": RESOLVE.format(edges="v_edge", inst="v_old_inst").replace("SELECT e.*", "SELECT e.* EXCLUDE (n, target, resolution_path)"),
    "v_open": "SELECT * EXCLUDE (status, resolved_sop, resolution_path, candidate_count) FROM v_old_resolved WHERE status = 'unresolved'",
    "v_again": RESOLVE.format(edges="v_open", inst="v_inst").replace("SELECT e.*", "SELECT e.* EXCLUDE (n, target, resolution_path)"),
}

SEQUENCE_OF = {kind: name for name, kind in V.REFERENCE_SEQUENCES.items()}


def header_json(spark, sf):
    """Instance headers as JSON whose reference sequences hold the edges of the fixture."""
    edges = X.edges(spark, sf)
    line = F.element_at(F.split("from_sop", r"\."), 5).cast("int")
    uids = [
        F.col("to_study").alias("ReferencedStudyInstanceUID"),
        F.col("to_series").alias("ReferencedSeriesInstanceUID"),
        F.col("to_sop").alias("ReferencedSOPInstanceUID"),
    ]
    item = F.to_json(F.struct(*uids, F.col("frame_number").alias("ReferencedFrameNumber")))
    odd_frame = F.to_json(F.struct(*uids, F.lit("x").alias("ReferencedFrameNumber")))
    items = (
        F.when(line % 5 == 0, item)
        .when(line % 2 == 0, F.concat(F.lit("["), item, F.lit(","), odd_frame, F.lit(',{"ReferencedFrameNumber":1}]')))
        .otherwise(F.concat(F.lit("["), item, F.lit("]")))
    )
    name = F.create_map(*[F.lit(x) for pair in SEQUENCE_OF.items() for x in pair])[F.col("relationship")]
    single = F.when(
        line % 3 == 0,
        F.concat(F.lit(',"ReferencedSOPClassUID":"1.2.840","ReferencedSOPInstanceUID":"'), F.col("to_sop"), F.lit('"')),
    ).otherwise("")
    return edges.select("from_sop", F.concat(F.lit('{"'), name, F.lit('":'), items, single, F.lit("}")).alias("raw_tags"))


@query("refs_extract", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number FROM v_edge
UNION ALL SELECT from_sop, relationship, to_study, to_series, to_sop, NULL FROM v_edge
  WHERE CAST(split_part(from_sop, '.', 5) AS INTEGER) % 2 = 0 AND CAST(split_part(from_sop, '.', 5) AS INTEGER) % 5 <> 0
UNION ALL SELECT from_sop, 'referenced_instance', NULL, NULL, to_sop, NULL FROM v_edge WHERE to_sop IS NOT NULL""")
def refs_extract(spark, sf):
    return R.refs_extract(header_json(spark, sf))


def resolved(spark, sf, obs=None):
    return R.refs_resolve(X.edges(spark, sf, obs), X.instances(spark, sf, obs))


@query("refs_resolve", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, status, resolved_sop, resolution_path, candidate_count
FROM v_resolved""", GRAPH)
def refs_resolve(spark, sf):
    return resolved(spark, sf).drop("created_on")


EDGE_ID = "md5(concat_ws('|', from_sop, relationship, coalesce(to_study, ''), coalesce(to_series, ''), coalesce(to_sop, ''), CAST(coalesce(frame_number, 0) AS VARCHAR)))"


def old_instances(spark, sf):
    old = X.observations(spark, sf).where(F.col("job_id") <= LAST_STORED_JOB)
    return old.select("sop_instance_uid", "series_instance_uid", "study_instance_uid").distinct()


def old_resolved(spark, sf):
    return R.refs_resolve(X.edges(spark, sf), old_instances(spark, sf))


@query("edges_upsert", f"""
SELECT {EDGE_ID} AS edge_id, * FROM (
  SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, status, resolved_sop FROM v_resolved WHERE relationship = 'waveform'
  UNION ALL SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, status, resolved_sop FROM v_old_resolved WHERE relationship <> 'waveform'
  UNION ALL SELECT 'gone.' || from_sop, relationship, to_study, to_series, to_sop, frame_number, status, resolved_sop FROM v_old_resolved)""", GRAPH)
def edges_upsert(spark, sf):
    """Edges of one kind arrive again, resolved against more instances; others are stored only."""
    new = staged(resolved(spark, sf).where("relationship = 'waveform'"), "edges")
    old = staged(old_resolved(spark, sf).select(*R.EDGE, "status", "resolved_sop"), "edges")
    stored = old.unionByName(old.withColumn("from_sop", F.concat(F.lit("gone."), "from_sop")))
    return R.edges_upsert(stored, new.unionByName(new))


@query("edges_of_instance", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number FROM v_edge
WHERE relationship = 'source_instance' AND from_sop IN (SELECT sop_instance_uid FROM v_obs WHERE modality = 'DX')""")
def edges_of_instance(spark, sf):
    wanted = X.observations(spark, sf).where("modality = 'DX'")
    return R.edges_of_instance(X.edges(spark, sf), wanted, "source_instance").drop("created_on")


@query("edges_unresolved", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, created_on FROM v_resolved WHERE status = 'unresolved'
ORDER BY created_on, from_sop, relationship, to_study NULLS FIRST, to_series NULLS FIRST, to_sop NULLS FIRST, frame_number NULLS FIRST LIMIT 100""", GRAPH, dates=["created_on"])
def edges_unresolved(spark, sf):
    return R.edges_unresolved(resolved(spark, sf), 100).select(*R.EDGE, "created_on")


@query("edges_reresolve", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, resolved_sop, resolution_path
FROM v_again WHERE status = 'resolved'""", GRAPH)
def edges_reresolve(spark, sf):
    again = R.edges_reresolve(old_resolved(spark, sf), X.instances(spark, sf))
    return again.select(*R.EDGE, "resolved_sop", "resolution_path")


@query("edges_reresolve_delta", """
SELECT from_sop, relationship, to_study, to_series, to_sop, frame_number, resolved_sop, resolution_path
FROM v_again WHERE status = 'resolved'""", GRAPH)
def edges_reresolve_delta(spark, sf):
    """The instances that came after the stored jobs are the arrivals."""
    instances = X.instances(spark, sf)
    before = old_instances(spark, sf)
    arrivals = instances.join(before, "sop_instance_uid", "left_anti")
    again, _ = R.edges_reresolve_delta(old_resolved(spark, sf), R.candidate_counts(before), arrivals)
    return again.select(*R.EDGE, "resolved_sop", "resolution_path")


@query("edge_summary", """
SELECT from_sop, coalesce(relationship, '*') AS relationship, coalesce(status, '*') AS status, count(*) AS n
FROM v_resolved GROUP BY GROUPING SETS ((from_sop, relationship, status), (from_sop, relationship), (from_sop))""", GRAPH)
def edge_summary(spark, sf):
    return R.edge_summary(resolved(spark, sf))


# --- series conflicts --------------------------------------------------------------------

ATTEMPTS = {
    "v_accepted": """SELECT observation_id AS item_id, job_id, series_instance_uid, study_instance_uid FROM v_obs
        WHERE l_suppkey % 10 <> 0 AND l_partkey % 59 <> 0""",
}


def accepted(spark, sf):
    obs = X.observations(spark, sf)
    items = obs.select(
        F.col("observation_id").alias("item_id"), "job_id",
        F.when(F.col("l_suppkey") % 10 == 0, "rejected").otherwise("accepted").alias("outcome"),
    )
    headers = obs.select(
        F.col("observation_id").alias("item_id"),
        F.to_json(
            F.struct(
                F.when(F.col("l_partkey") % 59 != 0, F.col("series_instance_uid")).alias("SeriesInstanceUID"),
                F.col("study_instance_uid").alias("StudyInstanceUID"),
            )
        ).alias("raw_tags"),
    )
    return K.accepted_uploads(items, headers)


@query("attempts_build", """
SELECT md5(concat_ws('|', CAST(job_id AS VARCHAR), series_instance_uid)) AS attempt_id, job_id, series_instance_uid,
       min(study_instance_uid) AS study_instance_uid, count(*) AS uploaded_item_count
FROM v_accepted GROUP BY job_id, series_instance_uid""", ATTEMPTS)
def attempts_build(spark, sf):
    return K.attempts_build(accepted(spark, sf))


@query("attempt_links", """
SELECT item_id, md5(concat_ws('|', CAST(job_id AS VARCHAR), series_instance_uid)) AS attempt_id FROM v_accepted""", ATTEMPTS)
def attempt_links(spark, sf):
    return K.attempt_links(accepted(spark, sf))


CONFLICT = {
    "v_class": """SELECT md5(concat_ws('|', job_id, series_instance_uid)) AS attempt_id, job_id, series_instance_uid,
          CAST(up AS BIGINT) AS uploaded_item_count, up AS uploaded_sop_count, coalesce(ex, 0) AS existing_sop_count,
          CAST(ov AS BIGINT) AS overlap_sop_count, CAST(coalesce(cf, 0) AS BIGINT) AS conflicting_sop_count,
          CASE WHEN ex IS NULL THEN 0 ELSE ov / greatest(up, ex) END AS overlap_ratio,
          CASE WHEN ex IS NULL THEN 'none' WHEN cf > 0 THEN 'content_conflict' WHEN ov / greatest(up, ex) < 0.1 THEN 'uid_conflict'
               WHEN ov < greatest(up, ex) THEN 'partial_overlap' ELSE 'exact_duplicate' END AS classification
        FROM (SELECT u.job_id, u.series_instance_uid, count(*) AS up, count(s.sop_instance_uid) AS ov, count_if(u.sha <> s.sha) AS cf
              FROM v_upload u LEFT JOIN v_stored s USING (series_instance_uid, sop_instance_uid) GROUP BY 1, 2) a
        LEFT JOIN (SELECT series_instance_uid, count(*) AS ex FROM v_stored GROUP BY 1) USING (series_instance_uid)""",
    "v_conflict": """SELECT *, uploaded_sop_count - overlap_sop_count AS new_sop_count, existing_sop_count - overlap_sop_count AS missing_sop_count,
          CASE classification WHEN 'content_conflict' THEN 'critical' WHEN 'uid_conflict' THEN 'critical' WHEN 'partial_overlap' THEN 'warning'
               ELSE 'info' END AS severity,
          CASE WHEN classification = 'exact_duplicate' THEN 'auto_deduped' ELSE 'open' END AS status
        FROM v_class WHERE classification <> 'none'""",
    "v_decision": """SELECT attempt_id, seq, 'reviewer' || (n % 3) AS actor,
          CASE seq WHEN 1 THEN ['keep_existing','promote_uploaded','merge','keep_existing','promote_uploaded','merge'][n % 6 + 1]
               ELSE ['keep_existing','keep_existing','promote_uploaded','promote_uploaded','promote_uploaded','merge'][n // 6 % 6 + 1] END AS action
        FROM (SELECT attempt_id, CAST(split_part(series_instance_uid, '.', 4) AS BIGINT) AS n FROM v_class), (VALUES (1), (2)) t(seq)""",
    "v_decided": """SELECT d.*, CASE WHEN c.attempt_id IS NULL THEN 'ConflictSummaryNotFound'
               WHEN classification = 'exact_duplicate' THEN 'CannotResolveAutoDeduped'
               WHEN d.seq = 2 AND f.action IN ('keep_existing', 'promote_uploaded') AND f.action = d.action THEN ''
               WHEN d.seq = 2 AND f.action IN ('keep_existing', 'promote_uploaded') THEN 'ConflictAlreadyResolved'
               WHEN d.action NOT IN ('keep_existing', 'promote_uploaded') THEN 'InvalidAction' ELSE '' END AS error_code
        FROM v_decision d JOIN v_decision f ON f.attempt_id = d.attempt_id AND f.seq = 1
        LEFT JOIN v_conflict c ON c.attempt_id = d.attempt_id""",
}


def classified(spark, sf):
    return K.conflict_classify(X.uploads(spark, sf), X.stored_instances(spark, sf))


def summaries(spark, sf):
    return K.conflict_summary(classified(spark, sf)).withColumn("overlap_ratio", F.col("overlap_ratio").cast("double"))


def decisions(spark, sf):
    number = F.element_at(F.split("series_instance_uid", r"\."), 4).cast("bigint")
    first = X.pick(number % 6, ["keep_existing", "promote_uploaded", "merge"] * 2)
    second = X.pick(
        F.floor(number / 6) % 6,
        ["keep_existing", "keep_existing", "promote_uploaded", "promote_uploaded", "promote_uploaded", "merge"],
    )
    return (
        X.uploads(spark, sf)
        .select(*K.ATTEMPT)
        .distinct()
        .select(
            natural_key(*K.ATTEMPT).alias("attempt_id"),
            F.concat(F.lit("reviewer"), (number % 3).cast("string")).alias("actor"),
            F.posexplode(F.array(first, second)).alias("seq", "action"),
        )
        .withColumn("seq", F.col("seq") + 1)
    )


@query("conflict_classify", "SELECT * FROM v_class", CONFLICT)
def conflict_classify(spark, sf):
    return classified(spark, sf)


@query("conflict_summary", "SELECT * REPLACE (CAST(CAST(overlap_ratio AS DECIMAL(5,4)) AS DOUBLE) AS overlap_ratio) FROM v_conflict", CONFLICT)
def conflict_summary(spark, sf):
    return summaries(spark, sf)


@query("conflict_resolve", """
SELECT attempt_id, seq, action, actor, error_code = '' AS success, error_code,
       CASE WHEN error_code = '' AND action = 'keep_existing' THEN 'kept_existing' WHEN error_code = '' THEN 'promoted_uploaded' END AS status
FROM v_decided""", CONFLICT)
def conflict_resolve(spark, sf):
    return K.conflict_resolve(summaries(spark, sf), decisions(spark, sf))


@query("resolution_history", """
SELECT attempt_id, seq, action, actor, CASE WHEN action = 'keep_existing' THEN 'kept_existing' ELSE 'promoted_uploaded' END AS status
FROM v_decided WHERE error_code = ''""", CONFLICT)
def resolution_history(spark, sf):
    return K.resolution_history(K.conflict_resolve(summaries(spark, sf), decisions(spark, sf)))


@query("conflicts_of_job", """
SELECT attempt_id, series_instance_uid, classification, new_sop_count, missing_sop_count, status FROM v_conflict WHERE job_id = 'job3'""", CONFLICT)
def conflicts_of_job(spark, sf):
    return K.conflicts_of_job(summaries(spark, sf), "job3").select(
        "attempt_id", "series_instance_uid", "classification", "new_sop_count", "missing_sop_count", "status"
    )


@query("conflict_queue", """
SELECT job_id, series_instance_uid, classification, severity FROM v_conflict WHERE status = 'open'
ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 WHEN 'info' THEN 3 ELSE 4 END, job_id DESC, series_instance_uid LIMIT 100""", CONFLICT)
def conflict_queue(spark, sf):
    return K.conflict_queue(summaries(spark, sf), 100).select("job_id", "series_instance_uid", "classification", "severity")


@query("conflict_counts", """
SELECT status, classification, count(*) AS n FROM v_conflict GROUP BY status, classification""", CONFLICT)
def conflict_counts(spark, sf):
    return summaries(spark, sf).groupBy("status", "classification").agg(F.count(F.lit(1)).alias("n"))


@query("promote_uploaded", """
SELECT sop_instance_uid, coalesce(p.observation_id, c.observation_id) AS canonical_observation_id,
       CASE WHEN p.observation_id <> c.observation_id THEN c.observation_id END AS previous_observation_id
FROM (SELECT sop_instance_uid, observation_id FROM v_flagged WHERE is_canonical) c
LEFT JOIN (SELECT sop_instance_uid, arg_max(observation_id, struct_pack(a := observed_at, b := observation_id)) AS observation_id
           FROM v_obs WHERE job_id = 2001 GROUP BY sop_instance_uid) p USING (sop_instance_uid)""", FLAGGED)
def promote_uploaded(spark, sf):
    obs = X.observations(spark, sf)
    return K.promote_uploaded(C.canonical_pointers(obs), obs.where("job_id = 2001"))


@query("canonical_flags", """
SELECT observation_id, observation_id = coalesce(p, c) AS is_canonical FROM (
  SELECT observation_id, first_value(observation_id) OVER (PARTITION BY sop_instance_uid ORDER BY observed_at, observation_id) AS c,
         arg_max(observation_id, struct_pack(a := observed_at, b := observation_id)) FILTER (WHERE job_id = 2001) OVER (PARTITION BY sop_instance_uid) AS p
  FROM v_obs)""")
def canonical_flags(spark, sf):
    obs = X.observations(spark, sf)
    pointers = K.promote_uploaded(C.canonical_pointers(obs), obs.where("job_id = 2001"))
    return K.canonical_flags(obs, pointers).select("observation_id", "is_canonical")


@query("series_versions", """
WITH files AS (SELECT series_instance_uid, job_id, sop_instance_uid, min(whole_file_sha256) AS sha FROM v_obs GROUP BY ALL),
vers AS (SELECT series_instance_uid, job_id, count(*) AS file_count, row_number() OVER w AS version_no, lag(job_id) OVER w AS prev,
                coalesce(lag(count(*)) OVER w, 0) AS prev_count, lead(job_id) OVER w IS NULL AS newest
         FROM files GROUP BY series_instance_uid, job_id WINDOW w AS (PARTITION BY series_instance_uid ORDER BY job_id)),
cmp AS (SELECT v.series_instance_uid, v.job_id, count_if(p.sha IS NULL) AS new_n, count(*) FILTER (WHERE p.sha = f.sha) AS same_n, count(*) FILTER (WHERE p.sha <> f.sha) AS changed_n
        FROM vers v JOIN files f ON f.series_instance_uid = v.series_instance_uid AND f.job_id = v.job_id
        LEFT JOIN files p ON p.series_instance_uid = v.series_instance_uid AND p.job_id = v.prev AND p.sop_instance_uid = f.sop_instance_uid
        GROUP BY ALL)
SELECT series_instance_uid, job_id, CAST(version_no AS INTEGER) AS version_no, CASE WHEN newest THEN 'active' ELSE 'archived' END AS status, file_count,
       CAST(new_n AS BIGINT) AS new_sop_count, CAST(changed_n AS BIGINT) AS changed_sop_count, CAST(same_n AS BIGINT) AS unchanged_sop_count,
       CAST(prev_count - same_n - changed_n AS BIGINT) AS missing_sop_count
FROM vers JOIN cmp USING (series_instance_uid, job_id)""".replace("WITH files", "SELECT * FROM (WITH files") + ")")
def series_versions(spark, sf):
    files = X.observations(spark, sf).withColumnRenamed("whole_file_sha256", "sha")
    return K.series_versions(files)


# --- binding -----------------------------------------------------------------------------

BINDING = {
    "v_binding": """SELECT md5('binding|' || observation_id) AS binding_id, observation_id, sop_instance_uid,
          CASE WHEN reason IS NULL THEN 'proj' || (l_partkey % 10) ELSE 'system_default' END AS project_id,
          CASE WHEN reason IS NULL THEN 'user' || (l_partkey % 13) ELSE 'system' END AS user_id,
          reason AS fallback_reason, observed_at, job_id, l_partkey, l_suppkey
        FROM (SELECT *, CASE WHEN modality = 'US' THEN 'BINDING_CONTEXT_MISSING' WHEN l_partkey % 13 = 0 THEN 'BINDING_CONTEXT_INVALID' END AS reason FROM v_obs)""",
    "v_attempt": """SELECT binding_id, seq, (l_suppkey + seq) % 6 = 0 AS success,
          CASE WHEN (l_suppkey + seq) % 6 <> 0 THEN 'BindingFailed' || (seq % 2) END AS error_code,
          CASE WHEN (l_suppkey + seq) % 6 <> 0 AND seq % 3 <> 0 THEN 'try ' || seq END AS error_detail
        FROM v_binding, generate_series(1, l_partkey % 8) t(seq)""",
    "v_bound": """SELECT b.*, bound_seq IS NOT NULL AS is_bound,
          CASE WHEN bound_seq IS NOT NULL THEN bound_seq - 1 ELSE coalesce(last_seq, 0) END AS retry_count,
          CASE WHEN bound_seq IS NOT NULL THEN 'bound' WHEN last_seq IS NOT NULL THEN 'failed' ELSE 'pending' END AS binding_status, last_seq
        FROM v_binding b LEFT JOIN (SELECT binding_id, min(seq) FILTER (WHERE success) AS bound_seq, max(seq) AS last_seq FROM v_attempt GROUP BY 1) USING (binding_id)""",
}


def contexts(spark, sf, obs=None):
    obs = X.observations(spark, sf) if obs is None else obs
    return obs.where("modality <> 'US'").select(
        "observation_id",
        F.concat(F.lit("proj"), (F.col("l_partkey") % 10).cast("string")).alias("project_id"),
        F.when(F.col("l_partkey") % 13 != 0, F.concat(F.lit("user"), (F.col("l_partkey") % 13).cast("string"))).alias("user_id"),
    )


def bindings(spark, sf, obs=None):
    obs = X.observations(spark, sf) if obs is None else obs
    return B.binding_create(obs, None, contexts(spark, sf, obs))


def binding_attempts(spark, sf):
    tries = F.col("l_partkey") % 8
    return (
        X.observations(spark, sf)
        .select(
            natural_key(F.lit("binding"), "observation_id").alias("binding_id"),
            "l_suppkey",
            F.explode(F.when(tries > 0, F.sequence(F.lit(1).cast("bigint"), tries))).alias("seq"),
        )
        .withColumn("success", (F.col("l_suppkey") + F.col("seq")) % 6 == 0)
        .select(
            "binding_id", "seq", "success",
            F.when(~F.col("success"), F.concat(F.lit("BindingFailed"), (F.col("seq") % 2).cast("string"))).alias("error_code"),
            F.when(~F.col("success") & (F.col("seq") % 3 != 0), F.concat(F.lit("try "), F.col("seq").cast("string")))
            .alias("error_detail"),
        )
    )


def bound(spark, sf):
    """The bindings and the log of attempts are written first: each is read in several branches."""
    return B.binding_apply(staged(bindings(spark, sf), "bindings"), staged(binding_attempts(spark, sf), "attempts"))


@query("binding_create", f"""
SELECT binding_id, observation_id, sop_instance_uid, project_id, user_id, fallback_reason, 'pending' AS binding_status,
       CAST(0 AS BIGINT) AS retry_count, observed_at FROM v_binding WHERE job_id > {LAST_STORED_JOB}""", BINDING, dates=["observed_at"])
def binding_create(spark, sf):
    obs = X.observations(spark, sf)
    held = B.binding_create(obs.where(F.col("job_id") <= LAST_STORED_JOB), None, contexts(spark, sf))
    return B.binding_create(obs, held, contexts(spark, sf))


@query("binding_apply", """
SELECT binding_id, binding_status, retry_count, CASE WHEN is_bound THEN 'asset' END AS target_type,
       CASE WHEN is_bound THEN 'asset-' || md5(sop_instance_uid) END AS target_id,
       CASE WHEN is_bound THEN '/assets/' || md5(sop_instance_uid) END AS target_uri,
       CASE WHEN binding_status = 'failed' THEN 'BindingFailed' || (last_seq % 2) ELSE '' END AS error_code,
       CASE WHEN binding_status <> 'failed' THEN '' WHEN last_seq % 3 <> 0 THEN 'try ' || last_seq ELSE 'Unknown binding failure' END AS error_detail
FROM v_bound""", BINDING)
def binding_apply(spark, sf):
    return bound(spark, sf).select(
        "binding_id", "binding_status", "retry_count", "target_type", "target_id", "target_uri", "error_code", "error_detail"
    )


@query("binding_retryable", """
SELECT binding_id, binding_status, retry_count FROM v_bound WHERE binding_status IN ('failed', 'deferred', 'pending') AND retry_count < 5""", BINDING)
def binding_retryable(spark, sf):
    return B.binding_retryable(bound(spark, sf)).select("binding_id", "binding_status", "retry_count")


@query("binding_latest", """
SELECT sop_instance_uid, binding_id, observation_id, project_id, binding_status FROM (
  SELECT *, row_number() OVER (PARTITION BY sop_instance_uid ORDER BY observed_at DESC, binding_id DESC) AS rn FROM v_bound) WHERE rn = 1""", BINDING)
def binding_latest(spark, sf):
    return B.binding_latest(bound(spark, sf)).select(
        "sop_instance_uid", "binding_id", "observation_id", "project_id", "binding_status"
    )


@query("binding_summary", """
SELECT job_id, binding_status, CASE WHEN is_bound THEN 'asset' END AS target_type, count(*) AS n FROM v_bound GROUP BY ALL""", BINDING)
def binding_summary(spark, sf):
    return B.binding_summary(bound(spark, sf), X.observations(spark, sf))
