"""Queries over the read model, reindexing and schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators import binding as B
from obsledger.operators import canonical as C
from obsledger.operators import projection as P
from obsledger.operators import schema_evolution as E
from obsledger.plans import fixtures as X
from obsledger.plans.canonical_queries import FAMILY_SQL, FLAGGED, RANKED, findings_of
from obsledger.plans.graph_queries import BINDING, GRAPH, bindings, resolved
from obsledger.plans.registry import query
from obsledger.session import run_folder, staged

# stored read model: one line number missing, one at an old version, one with an old checksum
MISSING_LINE, OLD_VERSION_LINE, CHANGED_LINE = 7, 3, 5

LINE = "CAST(split_part(sop_instance_uid, '.', 5) AS INTEGER)"


def _checksum_sql() -> str:
    lines = ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in sorted(P.SOURCE))
    return f"substr(sha256(concat_ws(chr(10), {lines})), 1, 32)"


MODEL = {
    **FLAGGED, **GRAPH, **BINDING,
    "v_first_series": f"SELECT series_instance_uid, modality, {FAMILY_SQL} AS object_class_family FROM (SELECT *, {RANKED.format(key='series_instance_uid')} AS rn FROM v_obs) WHERE rn = 1",
    "v_first_study": f"SELECT study_instance_uid, study_date, patient_id, patient_name FROM (SELECT *, {RANKED.format(key='study_instance_uid')} AS rn FROM v_obs) WHERE rn = 1",
    "v_canon": """SELECT sop_instance_uid, sop_class_uid, series_instance_uid, study_instance_uid, observation_id AS canonical_observation_id,
        whole_file_sha256, pixel_digest, observed_at FROM v_flagged WHERE is_canonical""",
    "v_source": """SELECT c.*, modality, object_class_family, study_date, patient_id, patient_name, project_id, user_id,
          coalesce(binding_status, 'unbound') AS binding_status, coalesce(duplicate_flags, '') AS duplicate_flags,
          coalesce(reference_resolution_status, 'none') AS reference_resolution_status
        FROM v_canon c JOIN v_first_series USING (series_instance_uid) JOIN v_first_study USING (study_instance_uid)
        LEFT JOIN (SELECT sop_instance_uid, project_id, user_id, 'pending' AS binding_status
                   FROM (SELECT *, row_number() OVER (PARTITION BY sop_instance_uid ORDER BY observed_at DESC, binding_id DESC) AS rn FROM v_binding) WHERE rn = 1) USING (sop_instance_uid)
        LEFT JOIN (SELECT sop_instance_uid, array_to_string(list_sort(list_distinct(list(duplicate_type))), ',') AS duplicate_flags
                   FROM v_finding JOIN v_obs USING (observation_id) GROUP BY 1) USING (sop_instance_uid)
        LEFT JOIN (SELECT from_sop AS sop_instance_uid, CASE max(CASE status WHEN 'unresolved' THEN 3 WHEN 'ambiguous' THEN 2 ELSE 1 END)
                          WHEN 3 THEN 'unresolved' WHEN 2 THEN 'ambiguous' ELSE 'resolved' END AS reference_resolution_status
                   FROM v_resolved GROUP BY 1) USING (sop_instance_uid)""",
    "v_projection": f"""SELECT md5(sop_instance_uid) AS instance_id, study_instance_uid, series_instance_uid, sop_instance_uid, modality, study_date,
          object_class_family, binding_status, duplicate_flags, reference_resolution_status, '{V.EXTRACTOR_VERSION}' AS metadata_extractor_version,
          '{V.PROJECTION_VERSION}' AS projection_version, {_checksum_sql()} AS projection_source_checksum FROM v_source""",
}

# the simpler stored read model that the operators below start from
STORED_MODEL = {
    **FLAGGED,
    "v_canon": MODEL["v_canon"],
    "v_new": """SELECT md5(sop_instance_uid) AS instance_id, study_instance_uid, series_instance_uid, sop_instance_uid, observed_at, canonical_observation_id,
        md5(whole_file_sha256) AS projection_source_checksum, '1.0.0' AS projection_version FROM v_canon""",
    "v_held": f"""SELECT * REPLACE (CASE WHEN {LINE} = {CHANGED_LINE} THEN 'old' ELSE projection_source_checksum END AS projection_source_checksum,
        CASE WHEN {LINE} = {OLD_VERSION_LINE} THEN '0.9.0' ELSE projection_version END AS projection_version) FROM v_new WHERE {LINE} <> {MISSING_LINE}""",
    "v_state": """SELECT n.*, CASE WHEN h.instance_id IS NULL THEN 'missing' WHEN h.projection_source_checksum <> n.projection_source_checksum THEN 'checksum_changed'
        WHEN h.projection_version <> '1.0.0' THEN 'version_changed' ELSE 'current' END AS state FROM v_new n LEFT JOIN v_held h USING (instance_id)""",
}


INSTANCE = ["sop_class_uid", "series_instance_uid", "study_instance_uid", "whole_file_sha256"]


def canonical_instances(spark, sf, obs=None, columns=INSTANCE):
    """The first observation of each instance by arrival, with `columns` of it."""
    obs = X.observations(spark, sf) if obs is None else obs
    first = obs.groupBy("sop_instance_uid").agg(F.min(F.struct(*C.ARRIVAL, *columns)).alias("r"))
    return first.select("sop_instance_uid", *[f"r.{c}" for c in columns], "r.observed_at", F.col("r.observation_id").alias("canonical_observation_id"))


def projections(spark, sf):
    """The read model over observations that are written first, since a dozen branches read them; so is what each branch finds."""
    lines = X.table(spark, sf, "lineitem")
    obs = staged(X.observations(spark, sf, lines), "observations")
    columns = [c for c in INSTANCE if c != "whole_file_sha256"]
    return P.projection_build(
        staged(canonical_instances(spark, sf, obs, columns).drop("observed_at"), "instances"),
        staged(C.series_upsert(obs), "series"),
        staged(C.studies_upsert(obs), "studies"),
        obs,
        staged(B.binding_latest(staged(bindings(spark, sf, obs), "bindings")).select("sop_instance_uid", "project_id", "user_id", "binding_status"), "bindings"),
        staged(P.duplicate_facts(findings_of(obs), obs), "duplicates"),
        staged(P.reference_facts(resolved(spark, sf, obs)), "references"),
    )


def new_model(spark, sf):
    """Read model rows with a plain checksum, for the operators that only compare them."""
    empty = {c: F.lit(None).cast("string") for c in P.PROJECTION}
    obs = X.observations(spark, sf).withColumn("checksum", F.md5("whole_file_sha256"))
    rows = canonical_instances(spark, sf, obs, ["series_instance_uid", "study_instance_uid", "checksum"]).withColumns(
        {
            "instance_id": F.md5("sop_instance_uid"),
            "projection_source_checksum": F.col("checksum"),
            "projection_version": F.lit(V.PROJECTION_VERSION),
        }
    )
    return rows.withColumns({c: v for c, v in empty.items() if c not in rows.columns}).select(*P.PROJECTION)


def held_model(spark, sf):
    return held_of(new_model(spark, sf))


def held_of(new):
    """The read model as it is stored, made from the one that is built."""
    line = F.element_at(F.split("sop_instance_uid", r"\."), 5).cast("int")
    return new.where(line != MISSING_LINE).withColumns(
        {
            "projection_source_checksum": F.when(line == CHANGED_LINE, "old").otherwise(F.col("projection_source_checksum")),
            "projection_version": F.when(line == OLD_VERSION_LINE, "0.9.0").otherwise(F.col("projection_version")),
        }
    )


@query("projection_build", "SELECT * FROM v_projection", MODEL, dates=["study_date"])
def projection_build(spark, sf):
    return projections(spark, sf)


@query("projection_checksum", f"""
SELECT observation_id, substr(sha256(concat_ws(chr(10), {", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in sorted(["observation_id", "pixel_digest", "study_date", "modality"]))})), 1, 32) AS checksum
FROM v_obs""")
def projection_checksum(spark, sf):
    checksum = P.projection_checksum(["observation_id", "pixel_digest", "study_date", "modality"])
    return X.observations(spark, sf).select("observation_id", checksum.alias("checksum"))


@query("projection_stale", "SELECT instance_id, sop_instance_uid, state FROM v_state", STORED_MODEL)
def projection_stale(spark, sf):
    return P.projection_stale(new_model(spark, sf), held_model(spark, sf)).select("instance_id", "sop_instance_uid", "state")


@query("projection_merge", """
SELECT instance_id, study_instance_uid, series_instance_uid, sop_instance_uid, CASE state WHEN 'current' THEN 'held' ELSE 'fresh' END AS modality, projection_version, projection_source_checksum FROM v_state
UNION ALL SELECT md5('gone' || instance_id), study_instance_uid, series_instance_uid, sop_instance_uid, 'held', projection_version, projection_source_checksum FROM v_held""", STORED_MODEL)
def projection_merge(spark, sf):
    """Which side a row comes from shows in a column; the store also holds rows that are not built any more."""
    new = staged(new_model(spark, sf), "read-model")
    held = held_of(new).withColumn("modality", F.lit("held"))
    held = held.unionByName(held.withColumn("instance_id", F.md5(F.concat(F.lit("gone"), "instance_id"))))
    merged = P.projection_merge(new.withColumn("modality", F.lit("fresh")), held)
    return merged.select(
        "instance_id", "study_instance_uid", "series_instance_uid", "sop_instance_uid", "modality", "projection_version", "projection_source_checksum"
    )


FILTERED = "modality = 'MR' AND study_date >= DATE '1996-01-01' AND study_date <= DATE '1997-12-31' AND binding_status = 'pending'"


def filters():
    return {"modality": "MR", "study_date_from": "1996-01-01", "study_date_to": "1997-12-31", "binding_status": "pending"}


@query("projection_query", f"""
SELECT instance_id, sop_instance_uid, study_date FROM v_projection WHERE {FILTERED} ORDER BY instance_id LIMIT 100 OFFSET 100""", MODEL, dates=["study_date"])
def projection_query(spark, sf):
    page = P.projection_query(projections(spark, sf), page=2, per_page=100, **filters())
    return page.select("instance_id", "sop_instance_uid", "study_date")


@query("projection_count", f"SELECT count(*) AS total_count, count(*) > 200 AS has_more FROM v_projection WHERE {FILTERED}", MODEL)
def projection_count(spark, sf):
    return P.projection_count(projections(spark, sf), page=2, per_page=100, **filters())


SCOPE = P.Scope(from_date="1996-06-01", to_date="2000-06-30")
IN_SCOPE = "observed_at BETWEEN DATE '1996-06-01' AND DATE '2000-06-30'"


@query("rebuild_select", f"SELECT sop_instance_uid FROM v_state WHERE state IN ('missing', 'version_changed') AND {IN_SCOPE}", STORED_MODEL)
def rebuild_select(spark, sf):
    return P.rebuild_select(canonical_instances(spark, sf), held_model(spark, sf), SCOPE)


@query("projection_stats", """
SELECT count(*) AS total_canonical_instances, count(*) FILTER (WHERE state = 'missing') AS instances_without_projections,
       (count(*) - count(*) FILTER (WHERE state = 'missing')) / count(*) * 100 AS coverage_percentage FROM v_state""", STORED_MODEL)
def projection_stats(spark, sf):
    return P.projection_stats(canonical_instances(spark, sf), held_model(spark, sf))


@query("projection_versions", "SELECT projection_version, count(*) AS n FROM v_held GROUP BY 1", STORED_MODEL)
def projection_versions(spark, sf):
    return P.projection_versions(held_model(spark, sf))


@query("reindex_plan", f"""
SELECT *, affected_instances * 0.1::DOUBLE / 60 AS estimated_minutes, concat_ws('; ', CASE WHEN affected_instances > 10000 THEN 'Large scope: ' || affected_instances || ' instances' END,
       CASE WHEN stale_instances > 0 THEN stale_instances || ' instances have stale or missing projections' END) AS warnings
FROM (SELECT count(*) AS affected_instances, count(DISTINCT study_instance_uid) AS affected_studies,
             count(*) FILTER (WHERE state IN ('missing', 'version_changed')) AS stale_instances FROM v_state WHERE {IN_SCOPE})""", STORED_MODEL)
def reindex_plan(spark, sf):
    return P.reindex_plan(canonical_instances(spark, sf), held_model(spark, sf), SCOPE)


@query("reindex_verify", "SELECT count(*) AS instances_without_projections, CASE WHEN count(*) = 0 THEN 'success' ELSE 'warning' END AS status FROM v_state WHERE state = 'missing'", STORED_MODEL)
def reindex_verify(spark, sf):
    return P.reindex_verify(canonical_instances(spark, sf), held_model(spark, sf))


@query("reindex_summary", "SELECT count(*) AS total_projections, count(*) FILTER (WHERE projection_version = '1.0.0') AS current_version_projections FROM v_held", STORED_MODEL)
def reindex_summary(spark, sf):
    return P.reindex_summary(held_model(spark, sf))


@query("reindex_run", f"""
SELECT 1 AS step_no, 'analyze' AS step, 'success' AS status, count(*) AS n, concat_ws('; ', CASE WHEN count(*) > 10000 THEN 'Large scope: ' || count(*) || ' instances' END,
       count(*) FILTER (WHERE state IN ('missing', 'version_changed')) || ' instances have stale or missing projections') AS message FROM v_state WHERE {IN_SCOPE}
UNION ALL SELECT 2, 'rebuild_projections', 'success', count(*), 'Rebuilt ' || count(*) || ' projections' FROM v_state WHERE {IN_SCOPE}
UNION ALL SELECT 3, 'verify', 'success', 0, '0 instances missing projections'""", STORED_MODEL)
def reindex_run(spark, sf):
    path = run_folder(spark, "reindex_run")
    new = staged(new_model(spark, sf), "read-model")
    instances = staged(canonical_instances(spark, sf, columns=["study_instance_uid", "series_instance_uid"]), "instances")
    return P.reindex_run(instances, new, held_of(new), path, SCOPE)


@query("reindex_jobs", """
SELECT job_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM v_job WHERE status = 'completed' ORDER BY v_job.created_at DESC, job_id LIMIT 10""")
def reindex_jobs(spark, sf):
    newest = P.reindex_jobs(X.jobs(spark, sf), "completed", 10)
    return newest.select("job_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("study_rollup", "SELECT study_instance_uid, count(DISTINCT series_instance_uid) AS series_count, count(*) AS instance_count FROM v_inst GROUP BY 1")
def study_rollup(spark, sf):
    return P.study_rollup(X.instances(spark, sf))


@query("study_completeness", """
SELECT study_instance_uid, series_count, instance_count, CASE WHEN failures > 0 THEN 'partial' WHEN expected = instance_count THEN 'complete' ELSE 'unknown' END AS completeness
FROM (SELECT study_instance_uid, count(DISTINCT series_instance_uid) AS series_count, count(*) AS instance_count FROM v_inst GROUP BY 1)
LEFT JOIN (SELECT study_instance_uid, count(*) AS failures FROM v_obs WHERE modality = 'PT' AND NOT has_pixel_data GROUP BY 1) USING (study_instance_uid)
LEFT JOIN (SELECT '1.2.826.0.' || c_custkey AS study_instance_uid, c_nationkey * 3 AS expected FROM customer) USING (study_instance_uid)""")
def study_completeness(spark, sf):
    failures = X.observations(spark, sf).where("modality = 'PT' AND NOT has_pixel_data")
    manifests = X.table(spark, sf, "customer").select(
        F.concat(F.lit("1.2.826.0."), F.col("c_custkey").cast("string")).alias("study_instance_uid"),
        (F.col("c_nationkey") * 3).alias("expected_instances"),
    )
    return P.study_completeness(P.study_rollup(X.instances(spark, sf)), failures, manifests)


@query("series_browse", """
SELECT series_instance_uid, count(*) AS file_count, min(observed_at) AS earliest_file, max(observed_at) AS latest_file FROM v_obs
WHERE modality = 'CT' AND observed_at >= DATE '1997-01-01' AND lower(patient_name) LIKE '%customer^1%'
GROUP BY 1 ORDER BY latest_file DESC, series_instance_uid LIMIT 100""", dates=["earliest_file", "latest_file"])
def series_browse(spark, sf):
    return P.series_browse(X.observations(spark, sf), modality="CT", date_from="1997-01-01", patient_name="customer^1", limit=100)


# --- schema evolution --------------------------------------------------------------------

FIELDS = ["device", "modality", "protocol", "series_uid", "sop_uid", "study_uid"]
CURRENT = 11  # nation row that plays the current version

VERSION_SQL = "(1 + n_nationkey // 20) || '.' || (n_nationkey // 5 % 4) || '.' || (n_nationkey % 5)"
SCHEMA = {
    "v_registry": f"""SELECT n_nationkey AS n, {VERSION_SQL} AS version, 2 + n_nationkey % 4 AS r FROM nation""",
    "v_compat": f"""SELECT o.version AS old_version, c.version AS new_version,
          CASE WHEN o.n // 20 <> c.n // 20 THEN 'incompatible' WHEN c.n // 5 % 4 > o.n // 5 % 4 AND c.r > o.r THEN 'requires_reparse' ELSE 'compatible' END AS level,
          CASE WHEN o.n // 20 <> c.n // 20 THEN 'Major version changed: ' || o.version || ' -> ' || c.version
               WHEN c.n // 5 % 4 > o.n // 5 % 4 AND c.r > o.r THEN 'New required fields added: ' || array_to_string({FIELDS!r}[o.r + 1:c.r], ', ')
               WHEN c.n // 5 % 4 > o.n // 5 % 4 THEN 'Minor version with only optional additions'
               WHEN c.n % 5 > o.n % 5 THEN 'Patch version change only' ELSE 'Same version' END AS reason
        FROM v_registry o JOIN v_registry c ON c.n = {CURRENT}""",
    "v_series_row": """SELECT '1.2.826.' || o_orderkey AS series_instance_uid, ['CT', 'MR', 'DX', 'US', 'PT'][o_orderkey % 5 + 1] AS modality,
        CAST(o_orderdate AS DATE) AS updated_at, CASE WHEN o_orderkey % 50 <> 49 THEN version ELSE '9.9.' || o_orderkey % 3 END AS extracted_schema_version,
        ['current', 'stale', 'reparse_failed', 'current', 'current', 'current', 'current'][o_orderkey % 7 + 1] AS status_before,
        CASE o_orderkey % 7 WHEN 1 THEN 'schema_updated' WHEN 2 THEN 'reparse_error' END AS reason_before, o_orderkey % 7 IN (1, 2) AS mark_before
        FROM orders JOIN v_registry ON n = o_orderkey % 25""",
    "v_marked": """SELECT series_instance_uid, modality, updated_at, extracted_schema_version, CASE WHEN hit THEN 'stale' ELSE status_before END AS projection_status,
        CASE WHEN hit THEN coalesce(reason, 'Schema definition not found for ' || extracted_schema_version) ELSE reason_before END AS stale_reason, hit OR mark_before AS needs_reparse, level
        FROM (SELECT s.*, reason, coalesce(level, 'unknown') AS level, status_before = 'current' AND coalesce(level, 'unknown') <> 'compatible' AS hit
              FROM v_series_row s LEFT JOIN v_compat ON old_version = extracted_schema_version)""",
}


def registry(spark, sf):
    n = F.col("n_nationkey")
    fields = F.array(*[F.lit(f) for f in FIELDS])
    version = F.concat_ws(".", *[(p).cast("int").cast("string") for p in (1 + F.floor(n / 20), F.floor(n / 5) % 4, n % 5)])
    return X.table(spark, sf, "nation").select(
        "n_nationkey", version.alias("version"), F.slice(fields, 1, 2 + n % 4).alias("required"),
        F.slice(fields, 3 + n % 4, 1).alias("optional"),
    )


def compat(spark, sf):
    """Every stored version against the current one, which is a setting of the registry."""
    current = f"{1 + CURRENT // 20}.{CURRENT // 5 % 4}.{CURRENT % 5}"
    required = FIELDS[: 2 + CURRENT % 4]
    stored = registry(spark, sf).select(
        F.col("version").alias("old_version"), F.col("required").alias("old_required"), F.col("optional").alias("old_optional"),
        F.lit(current).alias("new_version"), F.array(*[F.lit(f) for f in required]).alias("new_required"),
    )
    return E.schema_compat(stored)


def marked(spark, sf):
    n = F.col("o_orderkey")
    versions = registry(spark, sf).select("n_nationkey", F.col("version").alias("extracted_schema_version"))
    series = (
        X.table(spark, sf, "orders")
        .select(
            F.concat(F.lit("1.2.826."), n.cast("string")).alias("series_instance_uid"),
            X.pick(n % 5, X.MODALITIES).alias("modality"), F.col("o_orderdate").cast("date").alias("updated_at"),
            X.pick(n % 7, ["current", "stale", "reparse_failed", "current", "current", "current", "current"]).alias("projection_status"),
            F.when(n % 7 == 1, "schema_updated").when(n % 7 == 2, "reparse_error").alias("stale_reason"),
            (n % 7).isin(1, 2).alias("needs_reparse"), (n % 25).cast("int").alias("n_nationkey"),
            F.when(n % 50 == 49, F.concat(F.lit("9.9."), (n % 3).cast("string"))).alias("_unregistered"),
        )
        .join(versions, "n_nationkey")
        .withColumn("extracted_schema_version", F.coalesce("_unregistered", "extracted_schema_version"))
        .drop("n_nationkey", "_unregistered")
    )
    return E.stale_by_version(series, compat(spark, sf))


@query("schema_compat", "SELECT * FROM v_compat", SCHEMA)
def schema_compat(spark, sf):
    return compat(spark, sf)


@query("stale_by_version", "SELECT * FROM v_marked", SCHEMA, dates=["updated_at"])
def stale_by_version(spark, sf):
    return marked(spark, sf)


@query("stale_counters", "SELECT level, count(*) AS n FROM v_marked GROUP BY level", SCHEMA)
def stale_counters(spark, sf):
    return E.stale_counters(marked(spark, sf))


@query("reparse_queue", """
SELECT series_instance_uid, modality, updated_at, extracted_schema_version FROM v_marked WHERE needs_reparse AND projection_status = 'stale'
ORDER BY CASE WHEN modality IN ('CT', 'MR') THEN 1 ELSE 2 END, updated_at, series_instance_uid LIMIT 100""", SCHEMA, dates=["updated_at"])
def reparse_queue(spark, sf):
    return E.reparse_queue(marked(spark, sf), 100).select("series_instance_uid", "modality", "updated_at", "extracted_schema_version")


REPARSED = {
    **SCHEMA,
    "v_reparsed": """SELECT series_instance_uid, CASE WHEN ok THEN '1.2.1' ELSE extracted_schema_version END AS extracted_schema_version,
          CASE WHEN ok THEN 'current' WHEN NOT ok THEN 'reparse_failed' ELSE projection_status END AS projection_status,
          CASE WHEN ok THEN NULL WHEN NOT ok THEN 'reparse_error' ELSE stale_reason END AS stale_reason,
          CASE WHEN ok THEN false ELSE needs_reparse END AS needs_reparse, CASE WHEN NOT ok THEN 1 ELSE 0 END AS reparse_error_count
        FROM (SELECT m.*, CASE WHEN modality = 'US' OR NOT needs_reparse THEN NULL ELSE modality <> 'MR' END AS ok FROM v_marked m)""",
}


def reparsed(spark, sf):
    before = marked(spark, sf).withColumn("reparse_error_count", F.lit(0))
    results = before.where("needs_reparse AND modality <> 'US'").select(
        "series_instance_uid", (F.col("modality") != "MR").alias("success")
    )
    return E.reparse_mark(before, results, "1.2.1")


@query("reparse_mark", "SELECT * FROM v_reparsed", REPARSED)
def reparse_mark(spark, sf):
    return reparsed(spark, sf).select(
        "series_instance_uid", "extracted_schema_version", "projection_status", "stale_reason", "needs_reparse", "reparse_error_count"
    )


@query("reparse_stats", """
SELECT count(*) AS total_series, count(*) FILTER (WHERE projection_status = 'stale') AS stale_count,
       count(*) FILTER (WHERE projection_status = 'reparse_failed') AS failed_count, count(*) FILTER (WHERE needs_reparse) AS pending_reparse FROM v_reparsed""", REPARSED)
def reparse_stats(spark, sf):
    return E.reparse_stats(reparsed(spark, sf))
