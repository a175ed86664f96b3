"""The flat read model per instance: build, staleness, merge, query, statistics, reindex."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.paging import limited, page_of
from obsledger.functions.keys import natural_key
from obsledger.functions.skew import lookup_join
from obsledger.session import shuffles_given_back

SOURCE = [
    "sop_instance_uid", "sop_class_uid", "canonical_observation_id", "series_instance_uid", "modality",
    "object_class_family", "study_instance_uid", "study_date", "patient_id", "patient_name", "whole_file_sha256",
    "pixel_digest", "project_id", "user_id", "binding_status", "duplicate_flags", "reference_resolution_status",
]
PROJECTION = [
    "instance_id", "study_instance_uid", "series_instance_uid", "sop_instance_uid", "modality", "study_date",
    "object_class_family", "binding_status", "duplicate_flags", "reference_resolution_status",
    "metadata_extractor_version", "projection_version", "projection_source_checksum",
]


def duplicate_facts(findings: DataFrame, observations: DataFrame) -> DataFrame:
    """Types of duplicates among an instance's observations, as sorted text."""
    by_instance = findings.join(observations.select("observation_id", "sop_instance_uid"), "observation_id")
    has = lambda kind: F.max(F.when(F.col("duplicate_type") == kind, F.lit(kind)))
    return by_instance.groupBy("sop_instance_uid").agg(
        F.concat_ws(",", has("content"), has("identity")).alias("duplicate_flags")
    )


def reference_facts(edges: DataFrame) -> DataFrame:
    """Worst resolution status among an instance's references."""
    n = lambda status: F.count_if(F.col("status") == status)
    return edges.groupBy(F.col("from_sop").alias("sop_instance_uid")).agg(
        F.when(n("unresolved") > 0, "unresolved").when(n("ambiguous") > 0, "ambiguous").otherwise("resolved")
        .alias("reference_resolution_status")
    )


def projection_checksum(columns: Sequence[str] = SOURCE) -> Column:
    """First half of the SHA-256 over `name=value` lines in name order, null written as null."""
    lines = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in sorted(columns)]
    return F.substring(F.sha2(F.concat_ws("\n", *lines), 256), 1, 32)


def projection_build(
    instances: DataFrame,
    series: DataFrame,
    studies: DataFrame,
    observations: DataFrame,
    bindings: DataFrame,
    duplicates: DataFrame,
    references: DataFrame,
) -> DataFrame:
    """Flat row per instance with a canonical observation.

    Every input but `observations` has one row per key; `bindings`, `duplicates` and
    `references` are keyed by instance. One series or study may own a large part of the
    instances; adaptive execution splits those two joins.
    """
    scatter = ["sop_instance_uid"]
    rows = lookup_join(
        instances, series.select("series_instance_uid", "modality", "object_class_family"),
        ["series_instance_uid"], scatter, "inner",
    )
    rows = lookup_join(
        rows, studies.select("study_instance_uid", "study_date", "patient_id", "patient_name"),
        ["study_instance_uid"], scatter, "inner",
    )
    canonical = observations.select(
        F.col("observation_id").alias("canonical_observation_id"), "whole_file_sha256", "pixel_digest"
    )
    rows = (
        rows.join(bindings.select("sop_instance_uid", "project_id", "user_id", "binding_status"), "sop_instance_uid", "left")
        .join(duplicates, "sop_instance_uid", "left")
        .join(references, "sop_instance_uid", "left")
        .join(canonical, "canonical_observation_id")  # last, so that its digests are not shuffled again
        .withColumns(
            {
                "binding_status": F.coalesce("binding_status", F.lit("unbound")),
                "duplicate_flags": F.coalesce("duplicate_flags", F.lit("")),
                "reference_resolution_status": F.coalesce("reference_resolution_status", F.lit("none")),
            }
        )
    )
    return rows.withColumns(
        {
            "instance_id": natural_key("sop_instance_uid"),
            "metadata_extractor_version": F.lit(V.EXTRACTOR_VERSION),
            "projection_version": F.lit(V.PROJECTION_VERSION),
            "projection_source_checksum": projection_checksum(),
        }
    ).select(PROJECTION)


def projection_stale(fresh: DataFrame, stored: DataFrame, version: str = V.PROJECTION_VERSION) -> DataFrame:
    """Each instance's state: missing, checksum_changed, version_changed or current."""
    held = stored.select(
        "instance_id", F.col("projection_source_checksum").alias("_checksum"), F.col("projection_version").alias("_version")
    )
    return fresh.join(held, "instance_id", "left").select(
        *fresh.columns,
        F.when(F.col("_checksum").isNull(), "missing")
        .when(F.col("_checksum") != F.col("projection_source_checksum"), "checksum_changed")
        .when(~F.col("_version").eqNullSafe(F.lit(version)), "version_changed")
        .otherwise("current")
        .alias("state"),
    )


def projection_merge(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows with the stale ones replaced and the missing ones added."""
    changed = projection_stale(fresh, stored).where(F.col("state") != "current").select(PROJECTION)
    kept = stored.select(PROJECTION).join(changed.select("instance_id"), "instance_id", "left_anti")
    return kept.select(PROJECTION).unionByName(changed)


def projection_filter(
    projections: DataFrame,
    study_instance_uid: str | None = None,
    series_instance_uid: str | None = None,
    sop_instance_uid: str | None = None,
    modality: str | None = None,
    study_date_from=None,
    study_date_to=None,
    binding_status: str | None = None,
) -> DataFrame:
    """Rows that pass the given filters; on a parquet table they reach the scan."""
    equal = {
        "study_instance_uid": study_instance_uid,
        "series_instance_uid": series_instance_uid,
        "sop_instance_uid": sop_instance_uid,
        "modality": modality,
        "binding_status": binding_status,
    }
    for column, value in equal.items():
        if value is not None:
            projections = projections.where(F.col(column) == value)
    if study_date_from is not None:
        projections = projections.where(F.col("study_date") >= F.lit(study_date_from).cast("date"))
    if study_date_to is not None:
        projections = projections.where(F.col("study_date") <= F.lit(study_date_to).cast("date"))
    return projections


def projection_query(projections: DataFrame, page: int = 1, per_page: int | None = None, after=None, **filters) -> DataFrame:
    """Matching rows by instance key: all, one page, or the page behind the key `after`."""
    matching = projection_filter(projections, **filters)
    if after is not None:
        return limited(matching.where(F.col("instance_id") > after).orderBy("instance_id"), per_page)
    return page_of(matching.orderBy("instance_id"), page, per_page)


def projection_count(projections: DataFrame, page: int = 1, per_page: int | None = None, **filters) -> DataFrame:
    """Number of matching rows, and whether any lie behind the page."""
    total = projection_filter(projections, **filters).agg(F.count(F.lit(1)).alias("total_count"))
    return total.withColumn("has_more", F.lit(False) if per_page is None else F.col("total_count") > page * per_page)


@dataclass(frozen=True)
class Scope:
    """Instances a rebuild covers: all, one study, one series, or a range of arrival dates."""

    study_uid: str | None = None
    series_uid: str | None = None
    from_date: str | None = None
    to_date: str | None = None

    def apply(self, instances: DataFrame) -> DataFrame:
        """`instances` has study_instance_uid, series_instance_uid and observed_at of the canonical observation."""
        if self.study_uid is not None:
            instances = instances.where(F.col("study_instance_uid") == self.study_uid)
        if self.series_uid is not None:
            instances = instances.where(F.col("series_instance_uid") == self.series_uid)
        if self.from_date is not None:
            instances = instances.where(F.col("observed_at") >= F.lit(self.from_date).cast("date"))
        if self.to_date is not None:
            instances = instances.where(F.col("observed_at") <= F.lit(self.to_date).cast("date"))
        return instances.where(F.col("canonical_observation_id").isNotNull())


def _with_version(instances: DataFrame, projections: DataFrame) -> DataFrame:
    held = projections.select("sop_instance_uid", F.col("projection_version").alias("_version"), F.lit(True).alias("_held"))
    return instances.join(held, "sop_instance_uid", "left")


def _outdated(version: str) -> Column:
    return F.col("_held").isNull() | ~F.col("_version").eqNullSafe(F.lit(version))


def rebuild_select(
    instances: DataFrame, projections: DataFrame, scope: Scope = Scope(), force: bool = False,
    version: str = V.PROJECTION_VERSION,
) -> DataFrame:
    """Instances in scope to rebuild: those missing or at another version, or all when forced."""
    covered = scope.apply(instances).select("sop_instance_uid").distinct()
    if force:
        return covered
    return _with_version(covered, projections).where(_outdated(version)).select("sop_instance_uid")


def projection_stats(instances: DataFrame, projections: DataFrame) -> DataFrame:
    """Coverage of the canonical instances."""
    canonical = instances.where(F.col("canonical_observation_id").isNotNull())
    counts = _with_version(canonical, projections).agg(
        F.count(F.lit(1)).alias("total_canonical_instances"),
        F.count_if(F.col("_held").isNull()).alias("instances_without_projections"),
    )
    total, missing = F.col("total_canonical_instances"), F.col("instances_without_projections")
    return counts.withColumn(
        "coverage_percentage", F.when(total > 0, (total - missing) / total * 100).otherwise(F.lit(0.0))
    )


def projection_versions(projections: DataFrame) -> DataFrame:
    return projections.groupBy("projection_version").agg(F.count(F.lit(1)).alias("n"))


def reindex_plan(
    instances: DataFrame, projections: DataFrame, scope: Scope = Scope(), version: str = V.PROJECTION_VERSION
) -> DataFrame:
    """What a rebuild would touch, how long it should take, and warnings; one row."""
    counts = _with_version(scope.apply(instances), projections).agg(
        F.count(F.lit(1)).alias("affected_instances"),
        F.count_distinct("study_instance_uid").alias("affected_studies"),
        F.count_if(_outdated(version)).alias("stale_instances"),
    )
    n, stale = F.col("affected_instances"), F.col("stale_instances")
    large = F.when(n > V.LARGE_SCOPE, F.concat(F.lit("Large scope: "), n.cast("string"), F.lit(" instances")))
    outdated = F.when(stale > 0, F.concat(stale.cast("string"), F.lit(" instances have stale or missing projections")))
    return counts.select(
        "*",
        (n * V.SECONDS_PER_INSTANCE / 60).alias("estimated_minutes"),
        F.concat_ws("; ", large, outdated).alias("warnings"),
    )


def reindex_verify(instances: DataFrame, projections: DataFrame) -> DataFrame:
    """Canonical instances without a projection, and the verdict; one row."""
    canonical = instances.where(F.col("canonical_observation_id").isNotNull())
    missing = canonical.join(projections.select("sop_instance_uid"), "sop_instance_uid", "left_anti").agg(
        F.count(F.lit(1)).alias("instances_without_projections")
    )
    return missing.withColumn(
        "status", F.when(F.col("instances_without_projections") == 0, "success").otherwise("warning")
    )


def reindex_summary(projections: DataFrame, version: str = V.PROJECTION_VERSION) -> DataFrame:
    return projections.agg(
        F.count(F.lit(1)).alias("total_projections"),
        F.count_if(F.col("projection_version") == version).alias("current_version_projections"),
    )


def reindex_run(
    instances: DataFrame, fresh: DataFrame, stored: DataFrame, path: str, scope: Scope = Scope(), dry_run: bool = False
) -> DataFrame:
    """Plan, rebuild into `path`, verify; one row per step with its status and counts.

    The rebuilt read model is written once and verified from what was written, so a lost
    executor costs the tasks it ran and nothing more. A dry run only plans.
    """
    plan = reindex_plan(instances, stored, scope).select(
        F.lit(1).alias("step_no"), F.lit("analyze").alias("step"), F.lit("success").alias("status"),
        F.col("affected_instances").alias("n"), F.col("warnings").alias("message"),
    )
    if dry_run:
        return plan
    spark = instances.sparkSession
    chosen = rebuild_select(instances, stored, scope, force=True)
    rebuilt = fresh.join(chosen, "sop_instance_uid", "left_semi").select(PROJECTION)
    kept = stored.select(PROJECTION).join(rebuilt.select("instance_id"), "instance_id", "left_anti").select(PROJECTION)
    with shuffles_given_back(spark):
        rebuilt.withColumn("rebuilt", F.lit(True)).unionByName(kept.withColumn("rebuilt", F.lit(False))).write.mode(
            "overwrite"
        ).option("compression", "zstd").parquet(path)
    written = spark.read.parquet(path)
    rebuild = written.agg(F.count_if("rebuilt").alias("n")).select(
        F.lit(2).alias("step_no"), F.lit("rebuild_projections").alias("step"), F.lit("success").alias("status"), "n",
        F.concat(F.lit("Rebuilt "), F.col("n").cast("string"), F.lit(" projections")).alias("message"),
    )
    verify = reindex_verify(scope.apply(instances), written).select(
        F.lit(3).alias("step_no"), F.lit("verify").alias("step"), "status",
        F.col("instances_without_projections").alias("n"),
        F.concat(F.col("instances_without_projections").cast("string"), F.lit(" instances missing projections")).alias("message"),
    )
    return plan.unionByName(rebuild).unionByName(verify)


def reindex_jobs(jobs: DataFrame, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Jobs of a status, newest first, all or the first `limit`."""
    if status is not None:
        jobs = jobs.where(F.col("status") == status)
    return limited(jobs.orderBy(F.desc("created_at"), "job_id"), limit)


def study_rollup(instances: DataFrame) -> DataFrame:
    """Series and instance counts per study, first counted per series."""
    return (
        instances.groupBy("study_instance_uid", "series_instance_uid")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("study_instance_uid")
        .agg(F.count(F.lit(1)).alias("series_count"), F.sum("_n").alias("instance_count"))
    )


def study_completeness(rollup: DataFrame, failures: DataFrame, manifests: DataFrame) -> DataFrame:
    """`unknown` unless failures are known (`partial`) or a trusted manifest's count matches (`complete`)."""
    failed = failures.groupBy("study_instance_uid").agg(F.count(F.lit(1)).alias("_failures"))
    promised = manifests.select("study_instance_uid", F.col("expected_instances").alias("_expected"))
    return (
        rollup.join(failed, "study_instance_uid", "left")
        .join(promised, "study_instance_uid", "left")
        .select(
            *rollup.columns,
            F.when(F.col("_failures") > 0, "partial")
            .when(F.col("_expected") == F.col("instance_count"), "complete")
            .otherwise("unknown")
            .alias("completeness"),
        )
    )


def series_browse(
    observations: DataFrame, modality: str | None = None, study_instance_uid: str | None = None,
    date_from=None, patient_name: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Series with their file count and first and last file, newest first."""
    if modality is not None:
        observations = observations.where(F.col("modality") == modality)
    if study_instance_uid is not None:
        observations = observations.where(F.col("study_instance_uid") == study_instance_uid)
    if date_from is not None:
        observations = observations.where(F.col("observed_at") >= F.lit(date_from).cast("date"))
    if patient_name is not None:
        observations = observations.where(F.contains(F.lower("patient_name"), F.lit(patient_name.lower())))
    series = observations.groupBy("series_instance_uid").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.min("observed_at").alias("earliest_file"),
        F.max("observed_at").alias("latest_file"),
    )
    return limited(series.orderBy(F.desc("latest_file"), "series_instance_uid"), limit)
