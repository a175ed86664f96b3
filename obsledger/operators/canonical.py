"""Studies, series, instances and observations, and which observation is canonical."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.keys import natural_key
from obsledger.functions.skew import SLOT, arrival_rank, group_by_slot, lookup_join

ARRIVAL = ("observed_at", "observation_id")


def arrival_bucket() -> Column:
    """Text that follows the order of arrival: the day, then the first digits of the hashed id."""
    return F.concat(F.col("observed_at").cast("string"), F.substring("observation_id", 1, 2))


def first_wins_upsert(
    batch: DataFrame,
    existing: DataFrame | None,
    key: str,
    attributes: Sequence[str],
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Rows of `existing` unchanged, plus one row per new key with its first-seen attributes.

    The first row is found by an aggregate that combines on the map side, so a key that
    fills much of the batch costs one row per input partition.
    """
    first = (
        group_by_slot(batch.where(F.col(key).isNotNull()), key)
        .agg(F.min_by(F.struct(*attributes), F.struct(*order)).alias("_first"))
        .select(key, *[F.col("_first")[a].alias(a) for a in attributes])
    )
    if existing is None:
        return first
    return existing.select(key, *attributes).unionByName(first.join(existing.select(key), key, "left_anti"))


def studies_upsert(observations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return first_wins_upsert(
        observations, existing, "study_instance_uid", ["patient_id", "patient_name", "study_date"]
    )


def series_upsert(observations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    batch = observations.select(
        "*",
        F.expr("try_cast(instance_number AS INT)").alias("series_number"),
        object_class_family(F.col("sop_class_uid")).alias("object_class_family"),
    )
    attributes = ["study_instance_uid", "modality", "series_number", "object_class_family"]
    return first_wins_upsert(batch, existing, "series_instance_uid", attributes)


def instances_upsert(observations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    batch = observations.withColumn("instance_number", F.expr("try_cast(instance_number AS INT)")).withColumnRenamed(
        "has_pixel_data", "pixel_data_present"
    )
    attributes = [
        "study_instance_uid", "series_instance_uid", "sop_class_uid", "instance_number", "pixel_data_present",
    ]
    return first_wins_upsert(batch, existing, "sop_instance_uid", attributes)


def object_class_family(sop_class_uid: Column, exact: bool = False) -> Column:
    """Family of a SOP class.

    By default the class roots are tested as substrings in list order. With `exact` the
    segment after the root must be the whole number, so that PET and RT are told from
    CR/DX and MR.
    """
    family = F.when(F.coalesce(sop_class_uid, F.lit("")) == "", None)
    for uid, name in V.CLASS_FAMILIES:
        if exact:
            hit = (sop_class_uid == uid) | sop_class_uid.startswith(uid + ".")
        else:
            hit = sop_class_uid.contains(uid)
        family = family.when(hit, name)
    return family.otherwise("OTHER")


def observations_append(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of `batch` that `ledger` does not hold yet; repeating a batch appends nothing."""
    return batch.dropDuplicates(["observation_id"]).join(
        ledger.select("observation_id"), "observation_id", "left_anti"
    )


def slotted_pointers(observations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """`canonical_pointers` with their hash slot, as the right side of a `lookup_join`."""
    first = group_by_slot(observations, "sop_instance_uid").agg(
        F.min(F.struct(*ARRIVAL)).alias("_first"), F.count(F.lit(1)).alias("observation_count")
    )
    first = first.withColumn("_first", F.col("_first.observation_id"))
    if existing is None:
        return first.withColumnRenamed("_first", "canonical_observation_id")
    held = existing.select(
        F.xxhash64("sop_instance_uid").alias(SLOT), "sop_instance_uid", F.col("canonical_observation_id").alias("_held")
    )
    return first.join(held, [SLOT, "sop_instance_uid"], "full_outer").select(
        SLOT,
        "sop_instance_uid",
        F.coalesce("_held", "_first").alias("canonical_observation_id"),
        F.coalesce("observation_count", F.lit(0)).alias("observation_count"),
    )


def canonical_pointers(observations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Canonical observation per instance: the existing pointer, else the first arrival."""
    return slotted_pointers(observations, existing).drop(SLOT)


def canonical_select(
    observations: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Observations with `is_canonical` and why."""
    flagged = lookup_join(
        observations,
        slotted_pointers(observations, existing),
        ["sop_instance_uid"],
        scatter=["observation_id"],
    )
    is_canonical = F.col("observation_id") == F.col("canonical_observation_id")
    return flagged.select(
        *observations.columns,
        is_canonical.alias("is_canonical"),
        F.when(is_canonical, "first_observation_becomes_canonical")
        .otherwise("canonical_already_exists")
        .alias("rationale"),
    )


def canonical_validate(instances: DataFrame, observations: DataFrame) -> DataFrame:
    """Check every instance's pointer: set, flagged canonical, and of the same instance."""
    target = observations.select(
        F.col("observation_id").alias("canonical_observation_id"),
        F.col("sop_instance_uid").alias("_owner"),
        F.col("is_canonical").alias("_flag"),
    )
    pointer = F.col("canonical_observation_id")
    return instances.join(target, "canonical_observation_id", "left").select(
        "sop_instance_uid",
        "canonical_observation_id",
        F.when(pointer.isNull(), "no_canonical_observation")
        .when(~F.coalesce("_flag", F.lit(False)), "not_marked_canonical")
        .when(F.col("_owner") != F.col("sop_instance_uid"), "belongs_to_other_instance")
        .otherwise("valid")
        .alias("verdict"),
    )


def canonical_current(instances: DataFrame, observations: DataFrame) -> DataFrame:
    """The canonical observation row of each instance."""
    pointers = instances.select(F.col("canonical_observation_id").alias("observation_id"))
    return observations.join(pointers, "observation_id", "left_semi")


def observation_history(observations: DataFrame) -> DataFrame:
    """All versions of each instance; the highest `version_no` is the newest."""
    return arrival_rank(
        observations, ["sop_instance_uid"], list(ARRIVAL), arrival_bucket(), "version_no"
    )


def failure_envelope(items: DataFrame) -> DataFrame:
    """One structured row per item that could not be persisted."""
    failed_at = F.coalesce(
        *[F.when(F.col(axis).isin("failed", "rejected"), F.lit(axis.removesuffix("_status"))) for axis in V.AXES],
        F.lit("unknown"),
    )
    return items.where(F.col("outcome").isin("failed", "rejected")).select(
        "item_id",
        failed_at.alias("failure_stage"),
        F.when(F.coalesce("error_code", F.lit("")) == "", V.PERSISTENCE_FAILED)
        .otherwise(F.col("error_code"))
        .alias("error_code"),
        F.coalesce("error_detail", F.lit("")).alias("error_message"),
        F.col("whole_file_sha256").alias("raw_bytes_hash"),
        F.col("updated_at").alias("failed_at"),
    )


def ledger_invariants(
    instances: DataFrame,
    series: DataFrame,
    studies: DataFrame,
    observations: DataFrame,
    findings: DataFrame,
    items: DataFrame,
    attempts: DataFrame,
    edges: DataFrame | None = None,
    private_tags: DataFrame | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Violated ledger rules as (rule, subject, n); empty when the ledger is sound.

    Natural keys: UIDs of studies, series and instances, `finding_id`, `edge_id`, creator and tag
    of an observation, series of a job's attempts, an actor's idempotency key (where there is
    one) and `item_fingerprint`. Rules on keys apply where a table has the columns.
    """

    def rows(df: DataFrame, rule: str, subject: str, count: Column | None = None) -> DataFrame:
        n = F.lit(1) if count is None else count
        return df.select(F.lit(rule).alias("rule"), F.col(subject).cast("string").alias("subject"), n.cast("bigint").alias("n"))

    def repeated(df: DataFrame, rule: str, *keys: str) -> DataFrame:
        found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        subject = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        return rows(found.select(subject.alias("subject"), "n"), rule, "subject", F.col("n"))

    checks = [
        repeated(instances, "instance_not_unique", "sop_instance_uid"),
        repeated(series, "series_not_unique", "series_instance_uid"),
        repeated(studies, "study_not_unique", "study_instance_uid"),
        repeated(observations.where("is_canonical"), "several_canonical_observations", "sop_instance_uid"),
        rows(series.join(studies, "study_instance_uid", "left_anti"), "series_without_study", "series_instance_uid"),
        rows(
            findings.where(F.col("matched_observation_id").isNull() & F.col("matched_instance_uid").isNull()),
            "finding_without_match", "observation_id",
        ),
        rows(
            items.where(F.col("attempt_id").isNotNull()).join(attempts, ["attempt_id", "job_id"], "left_anti"),
            "attempt_of_other_job", "item_id",
        ),
    ]
    if "series_instance_uid" in instances.columns:
        checks.append(rows(instances.join(series, "series_instance_uid", "left_anti"), "instance_without_series", "sop_instance_uid"))
    if "canonical_observation_id" in instances.columns:
        owners = observations.select(F.col("observation_id").alias("canonical_observation_id"), F.col("sop_instance_uid").alias("_owner"))
        pointed = instances.join(owners, "canonical_observation_id").where(F.col("_owner") != F.col("sop_instance_uid"))
        checks.append(rows(pointed, "canonical_of_other_instance", "sop_instance_uid"))
    keyed = [
        (findings, "finding_not_unique", ["finding_id"]),
        (attempts, "attempt_not_unique", ["job_id", "series_instance_uid"]),
        (items, "item_fingerprint_not_unique", ["item_fingerprint"]),
        (edges, "edge_not_unique", ["edge_id"]),
        (private_tags, "private_tag_not_unique", ["observation_id", "creator", "tag"]),
    ]
    checks += [repeated(df, rule, *keys) for df, rule, keys in keyed if df is not None and set(keys) <= set(df.columns)]
    if requests is not None:
        checks.append(repeated(requests.where("idempotency_key IS NOT NULL"), "idempotency_key_not_unique", "actor_id", "idempotency_key"))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def observation_diff(observations: DataFrame, tags: str = "tags") -> DataFrame:
    """Each later observation against the canonical one: changed hashes, and the tags that changed.

    `tags` is the column with the whole tag map; a tag that one side lacks equals a null one.
    """
    base = observations.where("is_canonical").select(
        "sop_instance_uid",
        F.col("observation_id").alias("base_observation_id"),
        F.col("whole_file_sha256").alias("_base_sha"),
        F.col("pixel_digest").alias("_base_pixels"),
        F.col(tags).alias("_base_tags"),
    )
    later = observations.where(~F.col("is_canonical"))
    joined = lookup_join(later, base, ["sop_instance_uid"], ["observation_id"], "inner")
    names = F.array_sort(F.array_union(F.map_keys(tags), F.map_keys("_base_tags")))
    changed = F.filter(names, lambda k: ~F.try_element_at(F.col(tags), k).eqNullSafe(F.try_element_at(F.col("_base_tags"), k)))
    return joined.select(
        "base_observation_id",
        F.col("observation_id").alias("compare_observation_id"),
        (~F.col("whole_file_sha256").eqNullSafe(F.col("_base_sha"))).alias("whole_file_sha256_changed"),
        (~F.col("pixel_digest").eqNullSafe(F.col("_base_pixels"))).alias("pixel_digest_changed"),
        F.array_join(changed, ",").alias("changed_tags"),
    )


def comments_active(comments: DataFrame) -> DataFrame:
    """Undeleted notes, numbered oldest first within their observation."""
    bucket = F.lpad((F.col("seq") / 1000).cast("bigint").cast("string"), 18, "0")
    return arrival_rank(
        comments.where(~F.col("deleted")), ["observation_id"], ["seq"], bucket, "position"
    )


def with_instance_key(df: DataFrame) -> DataFrame:
    """Add the content-derived instance key."""
    return df.withColumn("instance_id", natural_key("sop_instance_uid"))
