"""Replay and retry of items out of stored bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.paging import limited
from obsledger.functions.skew import arrival_rank
from obsledger.operators.lifecycle import any_failed


def replay_eligible(force: bool = False) -> Column:
    """Stored bytes, and a failure or a stage to retry unless forced."""
    stored = F.coalesce("storage_uri", F.lit("")) != ""
    if force:
        return stored
    failed = (F.coalesce("outcome", F.lit("")) == "failed") | (F.coalesce("last_retryable_stage", F.lit("")) != "")
    return stored & (failed | any_failed())


def replay_plan(items: DataFrame, from_stage: str = "all", force: bool = False) -> DataFrame:
    """Stages to replay per eligible item, each attempted or skipped by its axis status."""
    start = 0 if from_stage == "all" else V.REPLAY_STAGES.index(from_stage)
    steps = [
        F.struct(
            F.lit(i + 1).alias("stage_no"),
            F.lit(stage).alias("stage"),
            F.coalesce(F.col(axis), F.lit("pending")).alias("axis_status"),
        )
        for i, (stage, axis) in enumerate(zip(V.REPLAY_STAGES, V.AXES))
        if i >= start
    ]
    attempted = F.lit(True) if force else F.col("axis_status").isin(V.STAGE_NEEDS_REPLAY)
    return (
        items.where(replay_eligible(force))
        .select("item_id", F.inline(F.array(*steps)))
        .select("item_id", "stage_no", "stage", "axis_status", attempted.alias("attempted"))
    )


def retry_select(items: DataFrame, job_id=None, failed_only: bool = True, max_items: int | None = None) -> DataFrame:
    """Retryable items by id, all or the first `max_items`."""
    picked = items.where(F.col("storage_uri").isNotNull())
    if job_id is not None:
        picked = picked.where(F.col("job_id") == job_id)
    if failed_only:
        picked = picked.where(
            "outcome = 'failed' OR last_retryable_stage IS NOT NULL OR parse_status = 'failed' "
            "OR storage_status = 'failed' OR metadata_persistence_status = 'failed'"
        )
    return limited(picked.orderBy("item_id"), max_items)


def retry_summary(replays: DataFrame, dry_run: bool = False) -> DataFrame:
    """Totals per job over replayed items (job_id, item_id, success, error_code)."""
    succeeded = F.count_if("success")
    totals = replays.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        (F.lit(0).cast("bigint") if dry_run else succeeded).alias("succeeded"),
        (F.lit(0).cast("bigint") if dry_run else F.count_if(~F.col("success"))).alias("failed"),
        (F.lit(0).cast("bigint") if dry_run else F.count_if(~F.col("success") & F.col("error_code").isNotNull())).alias("errors"),
    )
    return totals.select("*", (F.lit(dry_run) | (F.col("failed") == 0)).alias("success"), F.lit(dry_run).alias("dry_run"))


def replay_history(log: DataFrame) -> DataFrame:
    """Replays of each item, numbered in order; the highest number is the newest."""
    second = F.date_format("replayed_at", "yyyy-MM-dd HH:mm:ss")
    return arrival_rank(log, ["item_id"], ["replayed_at", "event_id"], second, "replay_no")
