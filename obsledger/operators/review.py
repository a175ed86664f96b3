"""Review views and reports over items, jobs and what the ledger knows about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.paging import limited, page_of
from obsledger.functions.skew import lookup_join
from obsledger.functions.text import sanitize_detail, sanitize_path
from obsledger.operators.lifecycle import all_completed, any_failed

NEEDS_REVIEW = "outcome IS NULL OR outcome IN ('failed', 'quarantined')"


def _long(stats: DataFrame) -> DataFrame:
    """One (metric, value) row per column of a one-row frame."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in stats.columns])
    return stats.select(F.inline(pairs))


def ingestion_summary(jobs: DataFrame, items: DataFrame, as_of: Column, since: Column | None = None) -> DataFrame:
    """Jobs and items by state, those of the day before `as_of`, and jobs with failures."""
    if since is not None:
        jobs, items = jobs.where(F.col("created_at") >= since), items.where(F.col("created_at") >= since)
    recent = F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS")
    job_stats = jobs.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(~F.col("status").isin(V.TERMINAL_JOB_STATES)).alias("active_jobs"),
        F.count_if(F.col("status") == "completed").alias("completed_jobs"),
        F.count_if(F.col("status") == "failed").alias("failed_jobs"),
        F.count_if(recent).alias("jobs_last_24h"),
    )
    item_stats = items.agg(
        F.count(F.lit(1)).alias("total_items"),
        *[F.count_if(F.col("outcome") == o).alias(f"{o}_items") for o in V.OUTCOMES],
        F.count_if(F.col("outcome").isNull()).alias("items_pending_review"),
        F.count_if(recent).alias("items_last_24h"),
        F.count_distinct(F.when(F.col("outcome") == "failed", F.col("job_id"))).alias("jobs_with_failures"),
    )
    return _long(job_stats).unionByName(_long(item_stats))


def job_review(jobs: DataFrame, items: DataFrame) -> DataFrame:
    """Jobs with item counts by outcome, how many need review, and duration."""
    counts = items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("outcome") == "accepted").alias("completed_items"),
        F.count_if(F.col("outcome") == "failed").alias("failed_items"),
        F.count_if(F.col("outcome") == "quarantined").alias("quarantined_items"),
        F.count_if(F.col("outcome").isNull()).alias("pending_items"),
        F.count_if(F.expr(NEEDS_REVIEW)).alias("items_needing_review"),
    )
    numbers = [c for c in counts.columns if c != "job_id"]
    seconds = F.col("finished_at").cast("timestamp").cast("double") - F.col("created_at").cast("timestamp").cast("double")
    return jobs.join(counts, "job_id", "left").select(
        "job_id", "actor_id", "source_type", "status",
        F.col("status").isin(V.TERMINAL_JOB_STATES).alias("is_terminal"),
        seconds.cast("bigint").alias("duration_seconds"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers],
    )


def job_review_items(items: DataFrame) -> DataFrame:
    """The items of each job that need review, one row each: a job may have any number."""
    return items.where(NEEDS_REVIEW).select("job_id", "item_id", "outcome")


def job_errors(items: DataFrame, top: int | None = None) -> DataFrame:
    """Error codes per job by frequency, all or the `top` ones."""
    by_frequency = Window.partitionBy("job_id").orderBy(F.desc("n"), "error_code")
    ranked = (
        items.where(F.coalesce("error_code", F.lit("")) != "")
        .groupBy("job_id", "error_code")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("position", F.row_number().over(by_frequency))
    )
    return ranked if top is None else ranked.where(F.col("position") <= top)


def review_status() -> Column:
    """What a reviewer sees: from the outcome, else from failed axes."""
    return (
        F.when(F.col("outcome") == "quarantined", "quarantined")
        .when(F.col("outcome") == "rejected", "rejected")
        .when(F.col("outcome") == "accepted", "approved")
        .when(F.col("outcome") == "failed", "needs_attention")
        .when(any_failed(), "needs_attention")
        .otherwise("pending_review")
    )


def item_review(
    items: DataFrame,
    observations: DataFrame,
    findings: DataFrame,
    private_tags: DataFrame,
    edges: DataFrame,
    bindings: DataFrame,
) -> DataFrame:
    """Items with everything the ledger knows about them.

    Every fact is brought to one row per observation or instance before it is joined; items
    without an observation, which have no key for that, are scattered. `observations` has at
    most one row per item, `bindings` one per instance.
    """
    duplicate = findings.groupBy("observation_id").agg(F.min(F.struct("duplicate_type", "basis")).alias("_dup"))
    tagged = private_tags.groupBy("observation_id").agg(F.count(F.lit(1)).alias("_tags"))
    referring = edges.groupBy(F.col("from_sop").alias("sop_instance_uid")).agg(F.count(F.lit(1)).alias("_refs"))
    bound = bindings.select("sop_instance_uid", F.coalesce("binding_status", F.lit("bound")).alias("_binding"))
    seen = F.col("observation_id").isNotNull()
    error = F.coalesce("error_code", F.lit("")) != ""
    rows = items.join(observations.select("item_id", "observation_id", "sop_instance_uid"), "item_id", "left")
    for key, facts in (("observation_id", duplicate), ("observation_id", tagged), ("sop_instance_uid", referring), ("sop_instance_uid", bound)):
        rows = lookup_join(rows, facts, [key], ["item_id"])
    return (
        rows.select(
            "item_id", "job_id", "source_path", "byte_size", "outcome",
            all_completed().alias("is_complete"),
            any_failed().alias("has_failures"),
            F.when(error, F.concat("error_code", F.lit(": "), F.coalesce("error_detail", F.lit("No details")))).alias("error_summary"),
            F.when(F.col("_dup").isNotNull(), F.format_string("%s (%s)", "_dup.duplicate_type", "_dup.basis"))
            .when(seen, "no_duplicates_found").alias("duplicate_status"),
            (F.coalesce("_tags", F.lit(0)) > 0).alias("private_tags_persisted"),
            F.coalesce("_refs", F.lit(0)).alias("references_extracted"),
            F.when(seen, F.coalesce("_binding", F.lit("unbound"))).alias("review_binding_status"),
            review_status().alias("review_status"),
        )
    )


def items_for_review(
    items: DataFrame,
    job_id=None,
    status: str | None = None,
    outcome: str | None = None,
    has_failures: bool | None = None,
    page: int = 1,
    per_page: int | None = None,
    after_item=None,
) -> DataFrame:
    """Items by id, all or one page; every filter applies before a page is cut.

    `after_item` continues behind the last id of the page before, which stays cheap for
    deep pages where an offset would not.
    """
    picked = items.withColumn("review_status", review_status())
    if job_id is not None:
        picked = picked.where(F.col("job_id") == job_id)
    if outcome is not None:
        picked = picked.where(F.col("outcome") == outcome)
    if status is not None:
        picked = picked.where(F.col("review_status") == status)
    if has_failures:
        picked = picked.where(
            "parse_status = 'failed' OR storage_status = 'failed' OR metadata_persistence_status = 'failed'"
        )
    if after_item is not None:
        return limited(picked.where(F.col("item_id") > after_item).orderBy("item_id"), per_page)
    return page_of(picked.orderBy("item_id"), page, per_page)


def findings_view(
    findings: DataFrame, duplicate_type: str | None = None, observation_id=None, limit: int | None = None
) -> DataFrame:
    """Findings, newest first, optionally of one type or one observation, or only the first `limit`."""
    if duplicate_type is not None:
        findings = findings.where(F.col("duplicate_type") == duplicate_type)
    if observation_id is not None:
        findings = findings.where(F.col("observation_id") == observation_id)
    return limited(findings.orderBy(F.desc("observed_at"), "finding_id"), limit)


def review_report(
    jobs: DataFrame, items: DataFrame, conflicts: DataFrame, findings: DataFrame, as_of: Column, job_id=None, since=None
) -> DataFrame:
    """The review bundle as one dataset of (section, subject, detail) rows; every section is complete.

    `job_id` keeps the jobs, items and conflicts of one job, `since` what was created, and the
    findings observed, from that time on. Conflicts carry no time, findings no job.
    """
    if job_id is not None:
        jobs, items, conflicts = (df.where(F.col("job_id") == job_id) for df in (jobs, items, conflicts))
    if since is not None:
        since = F.lit(since).cast("timestamp")
        jobs, items = (df.where(F.col("created_at").cast("timestamp") >= since) for df in (jobs, items))
        findings = findings.where(F.col("observed_at").cast("timestamp") >= since)
    attention = items.where(review_status() == "needs_attention")
    parts = [
        ingestion_summary(jobs, items, as_of).select(
            F.lit("summary").alias("section"), F.col("metric").alias("subject"), F.col("value").cast("string").alias("detail")
        ),
        job_review(jobs, items).select(
            F.lit("job").alias("section"), F.col("job_id").cast("string").alias("subject"),
            F.concat_ws("/", "status", F.col("total_items").cast("string"), F.col("items_needing_review").cast("string"))
            .alias("detail"),
        ),
        attention.select(
            F.lit("item").alias("section"), F.col("item_id").cast("string").alias("subject"),
            F.coalesce("error_code", F.lit("")).alias("detail"),
        ),
        conflicts.select(
            F.lit("conflict").alias("section"), F.col("series_instance_uid").alias("subject"), F.col("classification").alias("detail")
        ),
        findings.select(
            F.lit("duplicate").alias("section"), F.col("finding_id").alias("subject"), F.col("duplicate_type").alias("detail")
        ),
    ]
    bundle = parts[0]
    for part in parts[1:]:
        bundle = bundle.unionByName(part)
    return bundle


def outcome_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        *[F.count_if(F.col("outcome") == o).alias(f"{o}_count") for o in V.OUTCOMES],
    )


def terminal_report(
    jobs: DataFrame, items: DataFrame, duplicates: DataFrame | None = None, unresolved: DataFrame | None = None
) -> DataFrame:
    """Final report per job. `duplicates` and `unresolved` are counts (job_id, n)."""
    report = jobs.select("job_id").join(outcome_counts(items), "job_id", "left")
    numbers = ["total_items", *[f"{o}_count" for o in V.OUTCOMES]]
    for name, extra in (("duplicate_findings", duplicates), ("unresolved_references", unresolved)):
        if extra is None:
            report = report.withColumn(name, F.lit(0).cast("bigint"))
        else:
            report = report.join(extra.select("job_id", F.col("n").alias(name)), "job_id", "left")
        numbers.append(name)
    report = report.select("job_id", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in numbers])
    accepted, total = F.col("accepted_count"), F.col("total_items")
    return report.withColumn(
        "classification",
        F.when(total == 0, "failure").when(accepted == total, "success").when(accepted > 0, "partial").otherwise("failure"),
    )


def terminal_items(items: DataFrame, status: str | None = None) -> DataFrame:
    if status is not None:
        items = items.where(F.col("outcome") == status)
    return items.select(
        "job_id", "item_id", "source_path", "outcome", "error_code", "error_detail", "binding_status", "index_status"
    )


def failure_summary(items: DataFrame) -> DataFrame:
    """Failed and rejected items per job by error code."""
    code = F.when(F.coalesce("error_code", F.lit("")) == "", "UNKNOWN").otherwise(F.col("error_code"))
    return (
        items.where(F.col("outcome").isin("failed", "rejected"))
        .groupBy("job_id", code.alias("error_code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def progress_report(items: DataFrame) -> DataFrame:
    """Unfinished items per job and the stage they stand at: the first one not completed."""
    stage = F.coalesce(
        *[
            F.when(F.coalesce(F.col(a), F.lit("pending")) != "completed", F.lit(s))
            for a, s in zip(V.AXES, V.REPLAY_STAGES)
        ],
        F.lit("done"),
    )
    return (
        items.where(F.col("outcome").isNull())
        .groupBy("job_id", stage.alias("stage"))
        .agg(F.count(F.lit(1)).alias("total_items"))
        .select("*", F.lit("in_progress").alias("classification"), F.lit(False).alias("report_ready"))
    )


def report_invariant(jobs: DataFrame, items: DataFrame) -> DataFrame:
    """Finished jobs whose outcome counts do not add up to their items are broken."""
    summed = F.col("_with_outcome")
    counted = items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"), F.count_if(F.col("outcome").isin(V.OUTCOMES)).alias("_with_outcome")
    )
    return jobs.where(F.col("status") == "completed").join(counted, "job_id").select(
        "job_id", "total_items", summed.alias("items_with_outcome"),
        F.when(summed == F.col("total_items"), "ok").otherwise("broken").alias("verdict"),
    )


def orphaned_objects(objects: DataFrame, items: DataFrame) -> DataFrame:
    """Stored objects no item points to."""
    used = items.where(F.col("storage_uri").isNotNull()).select("storage_uri")
    return objects.join(used, "storage_uri", "left_anti")


def ingest_report(items: DataFrame, source_errors: DataFrame) -> DataFrame:
    """Totals per job; errors of the source count as rejected and as warnings."""
    stored = (F.col("outcome") == "accepted") & (F.coalesce("storage_uri", F.lit("")) != "")
    totals = items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("outcome") == "accepted").alias("accepted_instances"),
        F.count_if(F.col("outcome") == "rejected").alias("_rejected"),
        F.count_if(F.col("outcome") == "failed").alias("failed_items"),
        F.count_if(stored).alias("stored_items"),
        F.count_if(stored & F.col("storage_uri").startswith("local-nas://")).alias("local_nas"),
        F.count_if(stored & F.col("storage_uri").startswith("s3://")).alias("object"),
    )
    errors = source_errors.groupBy("job_id").agg(F.count(F.lit(1)).alias("_errors"))
    joined = totals.join(errors, "job_id", "full_outer").na.fill(0)
    return joined.select(
        "job_id", "total_items", "accepted_instances",
        (F.col("_rejected") + F.col("_errors")).alias("rejected_items"),
        "failed_items", F.col("_errors").alias("warnings"), "stored_items", "local_nas", "object",
    )


def rejections(items: DataFrame, source_errors: DataFrame) -> DataFrame:
    """Rejected items and, cleaned of internal paths, the errors of the source."""
    rejected = items.where(F.col("outcome") == "rejected").select(
        "job_id", F.col("source_path").alias("relative_path"), F.col("error_code").alias("reason"),
        F.col("error_detail").alias("detail"),
    )
    reported = source_errors.select(
        "job_id",
        sanitize_path(F.col("path")).alias("relative_path"),
        F.coalesce("error_code", F.lit("SourceError")).alias("reason"),
        sanitize_detail(F.col("error_detail")).alias("detail"),
    )
    return rejected.unionByName(reported)


def fallback_counts(tags: DataFrame, tag_map: Column) -> DataFrame:
    """How often each field holds a placeholder value."""
    return (
        tags.select(F.explode(tag_map).alias("field", "fallback"))
        .where(F.col("fallback").isin(V.PLACEHOLDERS))
        .groupBy("field", "fallback")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def annotation_summary(items: DataFrame, refs: DataFrame) -> DataFrame:
    """References, items with and without them, and references by task type, as (metric, value)."""
    totals = (
        items.select("item_id", "error_code")
        .join(refs.groupBy("item_id").agg(F.count(F.lit(1)).alias("_refs")), "item_id", "left")
        .agg(
            F.coalesce(F.sum("_refs"), F.lit(0)).alias("referenced_items"),
            F.count_if(F.col("_refs") > 0).alias("items_with_annotations"),
            F.count_if(F.col("error_code") == V.MISSING_ANNOTATION).alias("items_missing_required_annotations"),
        )
    )
    by_task = (
        refs.where(F.coalesce("task_type", F.lit("")) != "")
        .groupBy(F.concat(F.lit("task_type:"), "task_type").alias("metric"))
        .agg(F.count(F.lit(1)).alias("value"))
    )
    return _long(totals).unionByName(by_task)
