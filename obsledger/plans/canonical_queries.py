"""Queries over the canonical ledger and its duplicates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsledger.operators import canonical as C
from obsledger.operators import duplicates as D
from obsledger.plans import fixtures as X
from obsledger.plans.registry import query
from obsledger.session import staged

LAST_STORED_JOB = 1997  # observations of jobs up to this year count as already in the ledger

RANKED = "row_number() OVER (PARTITION BY {key} ORDER BY observed_at, observation_id)"

FAMILY_SQL = """CASE WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.2%' THEN 'CT'
  WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.4%' THEN 'MR' WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.1%' THEN 'CR/DX'
  WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.6%' THEN 'US' WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.7%' THEN 'SC'
  WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.128%' THEN 'PET' WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.481%' THEN 'RT'
  WHEN sop_class_uid LIKE '%1.2.840.10008.5.1.4.1.1.88%' THEN 'SR' ELSE 'OTHER' END"""

FLAGGED = {
    "v_flagged": "SELECT *, row_number() OVER (PARTITION BY sop_instance_uid ORDER BY observed_at, observation_id) = 1 AS is_canonical FROM v_obs",
    "v_identity": """SELECT observation_id, 'identity' AS duplicate_type, 'sop_instance_uid' AS basis,
        CAST(NULL AS VARCHAR) AS matched_observation_id, sop_instance_uid AS matched_instance_uid, 'open' AS resolution_status, observed_at
        FROM v_flagged WHERE NOT is_canonical""",
    "v_pixel": """SELECT observation_id, 'content' AS duplicate_type, 'pixel_digest' AS basis, first_id AS matched_observation_id,
        CAST(NULL AS VARCHAR) AS matched_instance_uid, 'open' AS resolution_status, observed_at, group_size
        FROM (SELECT *, first_value(observation_id) OVER (PARTITION BY pixel_digest ORDER BY observed_at, observation_id) AS first_id,
                     count(*) OVER (PARTITION BY pixel_digest) AS group_size FROM v_obs WHERE pixel_digest IS NOT NULL)
        WHERE observation_id <> first_id""",
    "v_finding": """SELECT md5(concat_ws('|', observation_id, duplicate_type, basis, coalesce(matched_observation_id, ''), coalesce(matched_instance_uid, ''))) AS finding_id, *
        FROM (SELECT * FROM v_identity UNION ALL SELECT * EXCLUDE (group_size) FROM v_pixel)""",
}


def stored_and_new(spark, sf):
    obs = X.observations(spark, sf)
    return obs.where(F.col("job_id") <= LAST_STORED_JOB), obs.where(F.col("job_id") > LAST_STORED_JOB)


def flagged(spark, sf):
    return C.canonical_select(X.observations(spark, sf))


def pixel_findings(spark, sf):
    return D.content_duplicates(X.observations(spark, sf), "pixel_digest")


def findings_of(obs):
    """Findings of both kinds, each written first: several branches read them, and a kind's shuffles go before the next."""
    identity = staged(D.identity_duplicates(obs), "findings")
    content = staged(D.content_duplicates(obs, "pixel_digest").drop("group_size"), "findings")
    return identity.unionByName(content)


def all_findings(spark, sf):
    return findings_of(X.observations(spark, sf))


@query("studies_upsert", f"""
SELECT study_instance_uid, patient_id, patient_name, study_date
FROM (SELECT *, {RANKED.format(key="study_instance_uid")} AS rn FROM v_obs) WHERE rn = 1""", dates=["study_date"])
def studies_upsert(spark, sf):
    stored, new = stored_and_new(spark, sf)
    return C.studies_upsert(new, C.studies_upsert(stored))


@query("series_upsert", f"""
SELECT series_instance_uid, study_instance_uid, modality, TRY_CAST(instance_number AS INTEGER) AS series_number,
       {FAMILY_SQL} AS object_class_family
FROM (SELECT *, {RANKED.format(key="series_instance_uid")} AS rn FROM v_obs) WHERE rn = 1""")
def series_upsert(spark, sf):
    stored, new = stored_and_new(spark, sf)
    return C.series_upsert(new, C.series_upsert(stored))


@query("instances_upsert", f"""
SELECT sop_instance_uid, study_instance_uid, series_instance_uid, sop_class_uid,
       TRY_CAST(instance_number AS INTEGER) AS instance_number, has_pixel_data AS pixel_data_present
FROM (SELECT *, {RANKED.format(key="sop_instance_uid")} AS rn FROM v_obs) WHERE rn = 1""")
def instances_upsert(spark, sf):
    stored, new = stored_and_new(spark, sf)
    return C.instances_upsert(new, C.instances_upsert(stored))


@query("observations_append", f"""
SELECT observation_id, sop_instance_uid, job_id, whole_file_sha256 FROM v_obs WHERE job_id > {LAST_STORED_JOB}""")
def observations_append(spark, sf):
    stored, new = stored_and_new(spark, sf)
    appended = C.observations_append(stored, stored.unionByName(new).unionByName(new))
    return appended.select("observation_id", "sop_instance_uid", "job_id", "whole_file_sha256")


@query("canonical_select", """
SELECT observation_id, sop_instance_uid, is_canonical,
       CASE WHEN is_canonical THEN 'first_observation_becomes_canonical' ELSE 'canonical_already_exists' END AS rationale
FROM v_flagged""", FLAGGED)
def canonical_select(spark, sf):
    stored, new = stored_and_new(spark, sf)
    held = C.canonical_pointers(stored)
    return C.canonical_select(stored.unionByName(new), held).select(
        "observation_id", "sop_instance_uid", "is_canonical", "rationale"
    )


@query("canonical_validate", """
SELECT sop_instance_uid, canonical_observation_id,
       CASE WHEN canonical_observation_id IS NULL THEN 'no_canonical_observation'
            WHEN NOT coalesce(t.is_canonical, false) THEN 'not_marked_canonical'
            WHEN t.owner <> sop_instance_uid THEN 'belongs_to_other_instance' ELSE 'valid' END AS verdict
FROM (SELECT sop_instance_uid,
             CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN arg_max(observation_id, struct_pack(a := observed_at, b := observation_id))
                  WHEN 2 THEN any_value(series_first) ELSE min(observation_id) FILTER (WHERE is_canonical) END AS canonical_observation_id
      FROM (SELECT *, first_value(observation_id) OVER (PARTITION BY series_instance_uid ORDER BY observed_at, observation_id) AS series_first FROM v_flagged)
      GROUP BY sop_instance_uid, l_orderkey)
LEFT JOIN (SELECT observation_id, sop_instance_uid AS owner, is_canonical FROM v_flagged) t ON t.observation_id = canonical_observation_id
""", FLAGGED)
def canonical_validate(spark, sf):
    obs = staged(flagged(spark, sf).select("observation_id", "sop_instance_uid", "series_instance_uid", "l_orderkey", "observed_at", "is_canonical"), "flagged")
    first_of_series = obs.groupBy("series_instance_uid").agg(
        F.min_by("observation_id", F.struct(*C.ARRIVAL)).alias("series_first")
    )
    instances = (
        obs.groupBy("sop_instance_uid", "series_instance_uid", "l_orderkey")
        .agg(
            F.max_by("observation_id", F.struct(*C.ARRIVAL)).alias("newest"),
            F.min(F.when(F.col("is_canonical"), F.col("observation_id"))).alias("right"),
        )
        .join(first_of_series, "series_instance_uid")
        .select(
            "sop_instance_uid",
            F.when(F.col("l_orderkey") % 5 == 0, None)
            .when(F.col("l_orderkey") % 5 == 1, F.col("newest"))
            .when(F.col("l_orderkey") % 5 == 2, F.col("series_first"))
            .otherwise(F.col("right"))
            .alias("canonical_observation_id"),
        )
    )
    return C.canonical_validate(instances, obs)


@query("canonical_current", """
SELECT sop_instance_uid, observation_id, whole_file_sha256, pixel_digest, observed_at FROM v_flagged WHERE is_canonical""", FLAGGED, dates=["observed_at"])
def canonical_current(spark, sf):
    obs = X.observations(spark, sf)
    return C.canonical_current(C.canonical_pointers(obs), obs).select(
        "sop_instance_uid", "observation_id", "whole_file_sha256", "pixel_digest", "observed_at"
    )


@query("observation_history", f"""
SELECT sop_instance_uid, observation_id, observed_at, {RANKED.format(key="sop_instance_uid")} AS version_no FROM v_obs""", dates=["observed_at"])
def observation_history(spark, sf):
    return C.observation_history(X.observations(spark, sf)).select(
        "sop_instance_uid", "observation_id", "observed_at", "version_no"
    )


@query("failure_envelope", """
SELECT item_id, CASE WHEN scan_status IN ('failed','rejected') THEN 'scan' WHEN parse_status IN ('failed','rejected') THEN 'parse'
         WHEN storage_status IN ('failed','rejected') THEN 'storage' ELSE 'unknown' END AS failure_stage,
       CASE WHEN coalesce(error_code, '') = '' THEN 'MetadataPersistenceFailed' ELSE error_code END AS error_code,
       coalesce(error_detail, '') AS error_message, whole_file_sha256 AS raw_bytes_hash,
       strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS failed_at
FROM v_item WHERE outcome IN ('failed', 'rejected')""")
def failure_envelope(spark, sf):
    return C.failure_envelope(X.items(spark, sf)).withColumn(
        "failed_at", F.date_format("failed_at", "yyyy-MM-dd HH:mm:ss")
    )


INVARIANTS = {
    "v_series_row": """SELECT * FROM (SELECT DISTINCT series_instance_uid, study_instance_uid, l_orderkey % 10 = 0 AS twice FROM v_obs WHERE l_orderkey % 7 <> 3), (SELECT unnest([1, 2]) AS copy)
        WHERE copy = 1 OR twice""",
    "v_twice": "SELECT * FROM (SELECT o.*, unnest(CASE WHEN l_partkey % 9 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM v_obs o)",
}


@query("ledger_invariants", """
SELECT 'instance_not_unique' AS rule, sop_instance_uid AS subject, count(*) AS n FROM v_obs GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'series_not_unique', series_instance_uid, count(*) FROM v_series_row GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'study_not_unique', '1.2.826.0.' || c_custkey // 2, count(*) FROM customer WHERE c_acctbal > 0 GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'instance_without_series', sop_instance_uid, 1 FROM v_obs WHERE series_instance_uid NOT IN (SELECT series_instance_uid FROM v_series_row)
UNION ALL SELECT 'canonical_of_other_instance', i.sop_instance_uid, 1
  FROM (SELECT sop_instance_uid, CASE WHEN l_linenumber = 7 THEN min(observation_id) OVER (PARTITION BY l_orderkey) ELSE observation_id END AS p FROM v_obs) i
  JOIN v_obs o ON o.observation_id = p WHERE o.sop_instance_uid <> i.sop_instance_uid
UNION ALL SELECT 'finding_not_unique', md5(observation_id), count(*) FROM v_twice GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'edge_not_unique', 'e' || (l_orderkey % 100), count(*) FROM v_obs GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'private_tag_not_unique', observation_id || '||0009', count(*) FROM v_twice GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'attempt_not_unique', concat_ws('|', year(o_orderdate), '1.2.827.' || o_custkey), count(*) FROM orders GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'idempotency_key_not_unique', concat_ws('|', o_custkey, o_orderpriority), count(*) FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'item_fingerprint_not_unique', whole_file_sha256, count(*) FROM v_obs GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'several_canonical_observations', sop_instance_uid, count(*) FROM v_obs WHERE has_pixel_data GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'series_without_study', series_instance_uid, 1 FROM v_series_row
  WHERE study_instance_uid NOT IN (SELECT '1.2.826.0.' || c_custkey // 2 FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'finding_without_match', observation_id, 1 FROM v_twice WHERE pixel_digest IS NULL
UNION ALL SELECT 'attempt_of_other_job', observation_id, 1 FROM v_obs o
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = o.l_orderkey AND year(o_orderdate) = o.job_id)""", INVARIANTS)
def ledger_invariants(spark, sf):
    """A ledger in which every rule is broken somewhere; its observations, which most rules read, are written first."""
    obs = staged(X.observations(spark, sf), "observations")
    orders = X.table(spark, sf, "orders")
    studies = X.table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("1.2.826.0."), F.expr("CAST(c_custkey div 2 AS STRING)")).alias("study_instance_uid")
    )
    attempts = orders.select(
        F.concat(F.lit("1.2.826."), F.col("o_orderkey").cast("string")).alias("attempt_id"),
        F.year("o_orderdate").alias("job_id"),
        F.concat(F.lit("1.2.827."), F.col("o_custkey").cast("string")).alias("series_instance_uid"),
    )
    series = obs.where("l_orderkey % 7 <> 3").select("series_instance_uid", "study_instance_uid", (F.col("l_orderkey") % 10 == 0).alias("twice")).distinct()
    series = series.unionByName(series.where("twice")).drop("twice")
    twice = obs.unionByName(obs.where("l_partkey % 9 = 0"))
    first = F.min("observation_id").over(Window.partitionBy("l_orderkey"))
    return C.ledger_invariants(
        instances=obs.withColumn("canonical_observation_id", F.when(F.col("l_linenumber") == 7, first).otherwise(F.col("observation_id"))),
        series=series,
        studies=studies,
        observations=obs.withColumnRenamed("has_pixel_data", "is_canonical"),
        findings=twice.select(
            F.md5("observation_id").alias("finding_id"), "observation_id", F.col("pixel_digest").alias("matched_observation_id"),
            F.lit(None).alias("matched_instance_uid"),
        ),
        items=obs.select(
            F.col("observation_id").alias("item_id"), F.col("series_instance_uid").alias("attempt_id"), "job_id",
            F.col("whole_file_sha256").alias("item_fingerprint"),
        ),
        attempts=attempts,
        edges=obs.select(F.concat(F.lit("e"), (F.col("l_orderkey") % 100).cast("string")).alias("edge_id")),
        private_tags=twice.select("observation_id", F.lit(None).cast("string").alias("creator"), F.lit("0009").alias("tag")),
        requests=orders.select(
            F.col("o_custkey").alias("actor_id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("idempotency_key")
        ),
    )


COMPARED = sorted(X.TAG_SQL)


@query("observation_diff", f"""
SELECT b.observation_id AS base_observation_id, o.observation_id AS compare_observation_id,
       o.whole_file_sha256 IS DISTINCT FROM b.whole_file_sha256 AS whole_file_sha256_changed,
       o.pixel_digest IS DISTINCT FROM b.pixel_digest AS pixel_digest_changed,
       concat_ws(',', {", ".join(f'CASE WHEN o."{c}" IS DISTINCT FROM b."{c}" THEN {c!r} END' for c in COMPARED)}) AS changed_tags
FROM v_full o JOIN v_full b ON b.sop_instance_uid = o.sop_instance_uid AND b.is_canonical
WHERE NOT o.is_canonical""", {**FLAGGED, "v_full": "SELECT * FROM v_flagged JOIN v_tags USING (observation_id)"})
def observation_diff(spark, sf):
    """Flags and tags are written step by step, so that no two of the wide shuffles lie on disk at once."""
    tags = X.tags(spark, sf)
    tags = tags.select("observation_id", X.tag_map(tags).alias("tags"))
    flags = staged(flagged(spark, sf).select("observation_id", "sop_instance_uid", "is_canonical", "whole_file_sha256", "pixel_digest"), "flagged")
    return C.observation_diff(staged(flags.join(tags, "observation_id"), "tagged"))


@query("comments_active", """
SELECT observation_id, seq, comment_type, body, row_number() OVER (PARTITION BY observation_id ORDER BY seq) AS position
FROM v_comment WHERE NOT deleted""")
def comments_active(spark, sf):
    return C.comments_active(X.comments(spark, sf)).drop("deleted")


FINDING_COLUMNS = "finding_id, observation_id, duplicate_type, basis, matched_observation_id, matched_instance_uid, resolution_status, observed_at"


@query("identity_duplicates", f"""
SELECT {FINDING_COLUMNS} FROM v_finding WHERE duplicate_type = 'identity'""", FLAGGED, dates=["observed_at"])
def identity_duplicates(spark, sf):
    return D.identity_duplicates(X.observations(spark, sf))


@query("content_duplicates_pixel", """
SELECT md5(concat_ws('|', observation_id, duplicate_type, basis, matched_observation_id, '')) AS finding_id, * FROM v_pixel""", FLAGGED, dates=["observed_at"])
def content_duplicates_pixel(spark, sf):
    return pixel_findings(spark, sf)


@query("content_duplicates_file", """
SELECT md5(concat_ws('|', CAST(item_id AS VARCHAR), 'content', 'whole_file_sha256', CAST(first_id AS VARCHAR), '')) AS finding_id,
       item_id AS observation_id, 'content' AS duplicate_type, 'whole_file_sha256' AS basis, CAST(first_id AS VARCHAR) AS matched_observation_id,
       CAST(NULL AS VARCHAR) AS matched_instance_uid, 'open' AS resolution_status, CAST(created_at AS DATE) AS observed_at, group_size
FROM (SELECT *, first_value(item_id) OVER (PARTITION BY whole_file_sha256 ORDER BY CAST(created_at AS DATE), item_id) AS first_id,
             count(*) OVER (PARTITION BY whole_file_sha256) AS group_size FROM v_item)
WHERE item_id <> first_id""", dates=["observed_at"])
def content_duplicates_file(spark, sf):
    items = X.items(spark, sf).select(
        F.col("item_id").alias("observation_id"), F.col("created_at").cast("date").alias("observed_at"), "whole_file_sha256"
    )
    return D.content_duplicates(items, "whole_file_sha256")


@query("content_groups", """
SELECT pixel_digest, arg_min(observation_id, struct_pack(a := observed_at, b := observation_id)) AS first_observation_id,
       count(*) AS group_size, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS n_pairs
FROM v_obs WHERE pixel_digest IS NOT NULL GROUP BY pixel_digest HAVING count(*) > 1""")
def content_groups(spark, sf):
    return D.content_groups(X.observations(spark, sf), "pixel_digest")


@query("findings_upsert", f"""
SELECT {FINDING_COLUMNS} FROM (SELECT * REPLACE ('accepted' AS resolution_status) FROM v_finding WHERE duplicate_type = 'identity')
UNION ALL SELECT {FINDING_COLUMNS} FROM (SELECT * REPLACE (md5(finding_id) AS finding_id, 'accepted' AS resolution_status) FROM v_finding WHERE duplicate_type = 'identity')
UNION ALL SELECT {FINDING_COLUMNS} FROM v_finding WHERE duplicate_type <> 'identity'""", FLAGGED, dates=["observed_at"])
def findings_upsert(spark, sf):
    """Stored findings that someone has settled, among them some that are not found any more."""
    found = all_findings(spark, sf)
    settled = found.where("duplicate_type = 'identity'").withColumn("resolution_status", F.lit("accepted"))
    held = settled.unionByName(settled.withColumn("finding_id", F.md5("finding_id")))
    return D.findings_upsert(held, found.unionByName(found))


@query("findings_read", f"""
SELECT {FINDING_COLUMNS} FROM v_finding WHERE observation_id IN (SELECT observation_id FROM v_obs WHERE modality = 'CT')""", FLAGGED, dates=["observed_at"])
def findings_read(spark, sf):
    wanted = X.observations(spark, sf).where("modality = 'CT'")
    return D.findings_read(all_findings(spark, sf), wanted)


@query("duplicate_summary", """
SELECT job_id, count(*) AS total_findings, CAST(count_if(duplicate_type = 'identity') AS BIGINT) AS identity_duplicates,
       CAST(count_if(duplicate_type = 'content') AS BIGINT) AS content_duplicates,
       CAST(count_if(resolution_status = 'open') AS BIGINT) AS unresolved_count
FROM v_finding JOIN v_obs USING (observation_id) GROUP BY job_id""", FLAGGED)
def duplicate_summary(spark, sf):
    return D.duplicate_summary(all_findings(spark, sf), X.observations(spark, sf))


@query("duplicate_summary_by_instance", """
SELECT job_id, sop_instance_uid, duplicate_type, resolution_status, count(*) AS n
FROM v_finding JOIN v_obs USING (observation_id) GROUP BY ALL""", FLAGGED)
def duplicate_summary_by_instance(spark, sf):
    return D.duplicate_summary_by_instance(all_findings(spark, sf), X.observations(spark, sf))


@query("findings_resolve", """
SELECT finding_id, observation_id, duplicate_type,
       CASE WHEN observation_id IN (SELECT observation_id FROM v_obs WHERE modality = 'MR') THEN 'resolved' ELSE 'open' END AS resolution_status
FROM v_finding""", FLAGGED)
def findings_resolve(spark, sf):
    found = all_findings(spark, sf)
    decisions = D.findings_read(found, X.observations(spark, sf).where("modality = 'MR'"))
    return D.findings_resolve(found, decisions).select("finding_id", "observation_id", "duplicate_type", "resolution_status")


@query("series_duplicate_summary", """
SELECT series_instance_uid, study_instance_uid, count(*) AS instance_count,
       CAST(count_if(n > 1) AS BIGINT) AS duplicate_instance_count,
       CAST(count_if(n > 1 AND shas = 1) AS BIGINT) AS same_sop_same_checksum,
       CAST(count_if(n > 1 AND shas > 1) AS BIGINT) AS same_sop_different_checksum,
       CAST(count_if(n > 1 AND shas > 1) AS BIGINT) AS conflict_count,
       CASE WHEN count_if(n > 1) > 0 THEN 'HAS_DUPLICATES' ELSE 'NO_DUPLICATES' END AS duplicate_state,
       CASE WHEN count_if(n > 1 AND shas > 1) > 0 THEN 'REVIEW_CONFLICTS' WHEN count_if(n > 1) > 0 THEN 'KEEP_EXISTING' ELSE 'NONE' END AS recommended_action
FROM (SELECT series_instance_uid, study_instance_uid, sop_instance_uid, count(*) AS n, count(DISTINCT whole_file_sha256) AS shas
      FROM v_obs GROUP BY ALL)
GROUP BY series_instance_uid, study_instance_uid""")
def series_duplicate_summary(spark, sf):
    return D.series_duplicate_summary(X.observations(spark, sf))


@query("ledger_by_job", """
SELECT job_id, count(*) AS observations, CAST(count_if(is_canonical) AS BIGINT) AS canonical,
       CAST(count_if(NOT is_canonical) AS BIGINT) AS duplicates FROM v_flagged GROUP BY job_id""", FLAGGED)
def flagship(spark, sf):
    """Observations, canonical ones and identity duplicates per job."""
    return (
        flagged(spark, sf)
        .groupBy("job_id")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.count_if("is_canonical").alias("canonical"),
            F.count_if(~F.col("is_canonical")).alias("duplicates"),
        )
    )
