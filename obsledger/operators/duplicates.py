"""Identity and content duplicates as findings.

A finding links a later observation to the first one it repeats. A content group of n
observations gives n-1 findings, never all n(n-1)/2 pairs: together with `group_size`
they say the same, and the output stays linear however many copies a file has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.keys import natural_key
from obsledger.functions.skew import group_by_slot, lookup_join
from obsledger.operators.canonical import ARRIVAL, slotted_pointers

FINDING = [
    "finding_id", "observation_id", "duplicate_type", "basis", "matched_observation_id",
    "matched_instance_uid", "resolution_status", "observed_at",
]
FINDING_KEY = ["observation_id", "duplicate_type", "basis", "matched_observation_id", "matched_instance_uid"]


def _findings(df: DataFrame, kind: str, basis: str, matched_observation, matched_instance, *more: str) -> DataFrame:
    keyed = df.select(
        "observation_id",
        F.lit(kind).alias("duplicate_type"),
        F.lit(basis).alias("basis"),
        matched_observation.cast("string").alias("matched_observation_id"),
        matched_instance.cast("string").alias("matched_instance_uid"),
        F.lit("open").alias("resolution_status"),
        "observed_at",
        *more,
    )
    return keyed.select(natural_key(*FINDING_KEY).alias("finding_id"), *keyed.columns)


def identity_duplicates(
    observations: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Every observation of an instance other than its canonical one."""
    pointers = slotted_pointers(observations, existing)
    seen = lookup_join(
        observations, pointers, ["sop_instance_uid"], ["observation_id"], "inner"
    )
    later = seen.where(F.col("observation_id") != F.col("canonical_observation_id"))
    return _findings(later, "identity", "sop_instance_uid", F.lit(None), F.col("sop_instance_uid"))


def content_duplicates(observations: DataFrame, column: str) -> DataFrame:
    """Observations whose `column` hash was seen before; rows without a hash are left out."""
    hashed = observations.where(F.coalesce(F.col(column), F.lit("")) != "")
    groups = (
        group_by_slot(hashed, column)
        .agg(F.min(F.struct(*ARRIVAL)).alias("first_observation_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .withColumn("first_observation_id", F.col("first_observation_id.observation_id"))
    )
    seen = lookup_join(hashed, groups, [column], ["observation_id"], "inner")
    later = seen.where(F.col("observation_id") != F.col("first_observation_id"))
    return _findings(later, "content", column, F.col("first_observation_id"), F.lit(None), "group_size")


def content_groups(observations: DataFrame, column: str) -> DataFrame:
    """Size of each group of equal content and the number of pairs it stands for."""
    return (
        observations.where(F.coalesce(F.col(column), F.lit("")) != "")
        .groupBy(column)
        .agg(F.min(F.struct(*ARRIVAL)).alias("first_observation_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .withColumn("first_observation_id", F.col("first_observation_id.observation_id"))
        .withColumn("n_pairs", F.expr("group_size * (group_size - 1) div 2"))
    )


def findings_upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """`existing` plus the findings it does not hold, by natural key with null equal to null."""
    fresh = new.select(FINDING).dropDuplicates(["finding_id"])
    return existing.select(FINDING).unionByName(fresh.join(existing.select("finding_id"), "finding_id", "left_anti"))


def findings_read(findings: DataFrame, observations: DataFrame) -> DataFrame:
    """Findings of the requested observations."""
    return findings.join(observations.select("observation_id").distinct(), "observation_id", "left_semi")


def _with_subject(findings: DataFrame, observations: DataFrame) -> DataFrame:
    subject = observations.select("observation_id", "job_id", "sop_instance_uid")
    return findings.join(subject, "observation_id")


def duplicate_summary(findings: DataFrame, observations: DataFrame) -> DataFrame:
    """Findings per job: all, by type, unresolved."""
    return (
        _with_subject(findings, observations)
        .groupBy("job_id")
        .agg(
            F.count(F.lit(1)).alias("total_findings"),
            F.count_if(F.col("duplicate_type") == "identity").alias("identity_duplicates"),
            F.count_if(F.col("duplicate_type") == "content").alias("content_duplicates"),
            F.count_if(F.col("resolution_status") == "open").alias("unresolved_count"),
        )
    )


def duplicate_summary_by_instance(findings: DataFrame, observations: DataFrame) -> DataFrame:
    """The per-instance breakdown of `duplicate_summary`, one row per type and resolution."""
    return (
        _with_subject(findings, observations)
        .groupBy("job_id", "sop_instance_uid", "duplicate_type", "resolution_status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def findings_resolve(findings: DataFrame, decisions: DataFrame) -> DataFrame:
    """Mark the findings named in `decisions` as resolved."""
    decided = decisions.select("finding_id").distinct().withColumn("_decided", F.lit(True))
    return (
        findings.join(decided, "finding_id", "left")
        .withColumn(
            "resolution_status", F.when(F.col("_decided"), "resolved").otherwise(F.col("resolution_status"))
        )
        .drop("_decided")
    )


def series_duplicate_summary(observations: DataFrame) -> DataFrame:
    """Duplicates per series: first per instance, then per series."""
    per_instance = observations.groupBy("series_instance_uid", "study_instance_uid", "sop_instance_uid").agg(
        F.count(F.lit(1)).alias("_n"),
        (F.min("whole_file_sha256") != F.max("whole_file_sha256")).alias("_differs"),
    )
    repeated = F.col("_n") > 1
    summary = per_instance.groupBy("series_instance_uid", "study_instance_uid").agg(
        F.count(F.lit(1)).alias("instance_count"),
        F.count_if(repeated).alias("duplicate_instance_count"),
        F.count_if(repeated & ~F.col("_differs")).alias("same_sop_same_checksum"),
        F.count_if(repeated & F.col("_differs")).alias("same_sop_different_checksum"),
    )
    conflicts = F.col("same_sop_different_checksum")
    return summary.select(
        "*",
        conflicts.alias("conflict_count"),
        F.when(F.col("duplicate_instance_count") > 0, "HAS_DUPLICATES").otherwise("NO_DUPLICATES").alias("duplicate_state"),
        F.when(conflicts > 0, "REVIEW_CONFLICTS")
        .when(F.col("duplicate_instance_count") > 0, "KEEP_EXISTING")
        .otherwise("NONE")
        .alias("recommended_action"),
    )
