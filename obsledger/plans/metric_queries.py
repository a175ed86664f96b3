"""Queries over the event log: metrics, alerts, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators import metrics as M
from obsledger.plans import fixtures as X
from obsledger.plans.item_queries import AS_OF, as_of, replays
from obsledger.plans.registry import query

LABEL = "CASE WHEN status = 'completed' THEN 'success' ELSE status END"


@query("stage_counts", f"""
SELECT stage, {LABEL} AS status, count(*) AS n FROM v_event GROUP BY ALL
UNION ALL SELECT 'job', status, count(*) FROM v_job GROUP BY status""")
def stage_counts(spark, sf):
    jobs = M.job_counts(X.jobs(spark, sf)).select(F.lit("job").alias("stage"), "status", "n")
    return M.stage_counts(X.events(spark, sf)).unionByName(jobs)


@query("stage_errors", "SELECT stage, error_code, count(*) AS n FROM v_event WHERE status = 'failed' GROUP BY stage, error_code")
def stage_errors(spark, sf):
    return M.stage_errors(X.events(spark, sf))


def _histogram_sql(source: str, value: str, bounds, labels: str = "") -> str:
    cast = f"CAST(sum(CAST({value} AS DECIMAL(28,6))) AS DOUBLE) AS total, count(*) AS n"
    rows = [
        f"SELECT {labels} {cast}, '{b}' AS le, CAST(count(*) FILTER (WHERE {value} <= {b}) AS BIGINT) AS cumulative FROM {source} GROUP BY ALL"
        for b in bounds
    ]
    rows.append(f"SELECT {labels} {cast}, '+Inf' AS le, count(*) AS cumulative FROM {source} GROUP BY ALL")
    return " UNION ALL ".join(rows)


@query("stage_histogram", _histogram_sql("v_event", "duration_ms", V.STAGE_BUCKETS_MS, f"stage, {LABEL} AS status,"))
def stage_histogram(spark, sf):
    events = X.events(spark, sf).withColumn("status", M.success_label())
    return M.histogram(events, ["stage", "status"], "duration_ms", V.STAGE_BUCKETS_MS)


@query("histogram_quantile", f"""
SELECT stage, n, CASE WHEN hit IS NULL THEN CAST({V.STAGE_BUCKETS_MS[-1]} AS DOUBLE) ELSE
  low + (CAST(hit AS DOUBLE) - low) * ((0.99::DOUBLE * n - below) / (reached - below)) END AS estimate
FROM (SELECT stage, any_value(n) AS n, min(le) FILTER (WHERE cum >= 0.99::DOUBLE * n) AS hit,
             CAST(coalesce(max(le) FILTER (WHERE cum < 0.99::DOUBLE * n), 0) AS DOUBLE) AS low,
             coalesce(max(cum) FILTER (WHERE cum < 0.99::DOUBLE * n), 0) AS below, min(cum) FILTER (WHERE cum >= 0.99::DOUBLE * n) AS reached
      FROM (SELECT stage, le, n, count(*) FILTER (WHERE duration_ms <= le) AS cum
            FROM v_event JOIN (SELECT stage, count(*) AS n FROM v_event GROUP BY 1) USING (stage), (SELECT unnest({V.STAGE_BUCKETS_MS}) AS le) GROUP BY ALL)
      GROUP BY stage)""")
def histogram_quantile(spark, sf):
    return M.histogram_quantile(X.events(spark, sf), ["stage"], "duration_ms", V.STAGE_BUCKETS_MS, 0.99)


RATE_SQL = """
SELECT strftime(date_trunc('minute', ts) - to_minutes(back), '%Y-%m-%d %H:%M:%S') AS window_start, {labels} count(*) AS n, count(*) / 300 AS per_second
FROM v_event, (SELECT unnest([0, 1, 2, 3, 4]) AS back) GROUP BY ALL"""


@query("rate_5m", RATE_SQL.format(labels=f"{LABEL} AS status,"))
def rate_5m(spark, sf):
    events = X.events(spark, sf).withColumn("status", M.success_label())
    return M.rate(events, ["status"]).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


IN_PROGRESS = "CASE " + " ".join(f"WHEN {a} = 'in_progress' THEN '{s}'" for a, s in zip(V.AXES, V.REPLAY_STAGES)) + " END"


@query("stuck_items", f"""
SELECT item_id, job_id, stage FROM (SELECT *, {IN_PROGRESS} AS stage FROM v_item)
WHERE stage IS NOT NULL AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE""")
def stuck_items(spark, sf):
    return M.stuck_items(X.items(spark, sf), as_of()).select("item_id", "job_id", "stage")


LAG = {
    "v_lag": """SELECT item_id, (epoch_us(i) - epoch_us(p)) / 1000000 AS lag_seconds
        FROM (SELECT item_id, min(ts) FILTER (WHERE stage = 'metadata_persistence') AS p, min(ts) FILTER (WHERE stage = 'indexing') AS i FROM v_event GROUP BY item_id)
        WHERE i >= p""",
}


@query("index_lag", _histogram_sql("v_lag", "lag_seconds", V.LAG_BUCKETS_S), LAG)
def index_lag(spark, sf):
    return M.histogram(M.index_lag(X.events(spark, sf)), [], "lag_seconds", V.LAG_BUCKETS_S)


@query("recovery_histogram", _histogram_sql("v_replayed", "duration_ms", V.RECOVERY_BUCKETS_MS), {
    "v_replayed": "SELECT duration_ms FROM v_event WHERE status IN ('completed', 'failed')"})
def recovery_histogram(spark, sf):
    return M.recovery_histogram(replays(spark, sf))


@query("recovery_time", """
SELECT CASE WHEN status = 'completed' THEN 'success' ELSE 'failed' END AS status, count(*) AS n,
       CAST(sum(CAST(duration_ms AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS mean_ms
FROM v_event WHERE status IN ('completed', 'failed') GROUP BY 1""")
def recovery_time(spark, sf):
    return M.recovery_time(replays(spark, sf))


@query("alert_rules", f"""
SELECT rule, value, CASE WHEN p = 9 THEN 'ok' ELSE 'P' || p END AS level FROM (
  SELECT * FROM (SELECT 'error_rate' AS rule, v AS value, CASE WHEN v > 0.05 THEN 2 WHEN v >= 0.01 THEN 3 ELSE 9 END AS p
                 FROM (SELECT count(*) FILTER (WHERE status = 'failed') / count(*) AS v FROM v_event))
  UNION ALL SELECT 'index_lag', v, CASE WHEN v > 60 THEN 3 ELSE 9 END FROM (SELECT coalesce(max(lag_seconds), 0) AS v FROM v_lag)
  UNION ALL SELECT 'stuck_items', v, CASE WHEN v > 0 THEN 3 ELSE 9 END
    FROM (SELECT CAST(count(*) AS DOUBLE) AS v FROM v_item WHERE {IN_PROGRESS} IS NOT NULL AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE)
  UNION ALL SELECT 'overall', NULL, least(CASE WHEN (SELECT count(*) FILTER (WHERE status = 'failed') / count(*) FROM v_event) > 0.05 THEN 2 ELSE 9 END, 3))""", LAG)
def alert_rules(spark, sf):
    return M.alert_rules(X.events(spark, sf), X.items(spark, sf), as_of())


@query("alert_episodes", """
SELECT stage, strftime(min(w), '%Y-%m-%d %H:%M:%S') AS started_at, strftime(max(w) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS ended_at, count(*) AS n_windows,
  CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_failed) AS BIGINT) AS n_failed, max(n_failed / n) AS worst_rate
FROM (SELECT *, epoch(w) // 3600 - row_number() OVER (PARTITION BY stage ORDER BY w) AS island FROM (
  SELECT stage, date_trunc('hour', ts) AS w, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS n_failed FROM v_event GROUP BY ALL)
  WHERE n_failed / n > 0.01 AND w + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-25 12:00:00')
GROUP BY stage, island HAVING count(*) >= 2""")
def alert_episodes(spark, sf):
    """Hours over one per cent, two or more in a row, per stage."""
    found = M.alert_episodes(X.events(spark, sf), ["stage"], 0.01, 3600, 7200, F.lit("2024-01-25 12:00:00").cast("timestamp_ntz"))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started_at", "ended_at")})


@query("quantile_sketches", """
SELECT stage, quantile, count(*) AS n, true AS within_bound FROM v_event, (SELECT unnest([0.5::DOUBLE, 0.95, 0.99]) AS quantile) WHERE duration_ms IS NOT NULL GROUP BY ALL""")
def quantile_sketches(spark, sf):
    """Sketches of five minutes merged over all time, held against the exact rank of their estimates."""
    events = X.events(spark, sf)
    found = M.sketch_quantiles(M.quantile_sketches(events, ["stage"], "duration_ms"), ["stage"], [0.5, 0.95, 0.99])
    exact = events.join(found, "stage").groupBy("stage", "quantile", found.n).agg(
        F.count_if(F.col("duration_ms") < F.col("estimate")).alias("_below"), F.count_if(F.col("duration_ms") <= F.col("estimate")).alias("_upto")
    )
    bound = 2 * M.sketch_rank_error(800)
    within = (F.col("_below") / F.col("n") <= F.col("quantile") + bound) & (F.col("_upto") / F.col("n") >= F.col("quantile") - bound)
    return exact.select("stage", "quantile", "n", within.alias("within_bound"))


AUDIT = {
    "v_audit": """SELECT event_id, 'user' || job_id AS actor_id, ['CREATE', 'READ', 'REPLAY', 'EXPORT'][event_id % 4 + 1] AS action,
        'ingestion_item' AS resource_type, CAST(item_id AS VARCHAR) AS resource_id,
        CASE event_id % 4 WHEN 1 THEN 'study_instance_uid,series_instance_uid' WHEN 2 THEN 'dicom_metadata' ELSE '' END AS sensitive_fields,
        status <> 'failed' AS success, event_id % 4 IN (1, 2) AS sensitive_accessed FROM v_event""",
}


def audit(spark, sf):
    kind = F.col("event_id") % 4
    actions = X.events(spark, sf).select(
        "event_id", F.concat(F.lit("user"), F.col("job_id").cast("string")).alias("actor_id"),
        X.pick(kind, ["CREATE", "READ", "REPLAY", "EXPORT"]).alias("action"),
        F.lit("ingestion_item").alias("resource_type"), F.col("item_id").cast("string").alias("resource_id"),
        F.when(kind == 1, F.array(F.lit("study_instance_uid"), F.lit("series_instance_uid")))
        .when(kind == 2, F.array(F.lit("dicom_metadata"))).otherwise(F.array().cast("array<string>")).alias("sensitive_fields"),
        (F.col("status") != "failed").alias("success"),
    )
    return M.audit_log(actions)


@query("audit_log", "SELECT * FROM v_audit", AUDIT)
def audit_log(spark, sf):
    return audit(spark, sf).withColumn("sensitive_fields", F.array_join("sensitive_fields", ","))


@query("audit_access_counts", """
SELECT actor_id, action, count(*) AS n, count(*) FILTER (WHERE sensitive_accessed) AS n_sensitive, count(*) FILTER (WHERE NOT success) AS n_failed
FROM v_audit GROUP BY actor_id, action""", AUDIT)
def audit_access_counts(spark, sf):
    return M.audit_access_counts(audit(spark, sf))
