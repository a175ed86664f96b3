"""Items and jobs: identity, status axes, outcomes, state transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.keys import item_fingerprint
from obsledger.functions.skew import lookup_join, previous_row


def axes() -> Column:
    """The seven status columns as one array, absent ones pending."""
    return F.array(*[F.coalesce(F.col(a), F.lit("pending")) for a in V.AXES])


def all_completed() -> Column:
    return F.forall(axes(), lambda s: s == "completed")


def any_failed() -> Column:
    return F.exists(axes(), lambda s: s == "failed")


def fingerprint_items(items: DataFrame) -> DataFrame:
    """One row per fingerprint; the lowest item id stands for repeated ones."""
    key = item_fingerprint(F.col("job_id"), F.col("source_kind"), F.col("source_path"), F.col("byte_size"))
    return items.groupBy(key.alias("item_fingerprint")).agg(F.min("item_id").alias("item_id"))


def job_idempotency(requests: DataFrame) -> DataFrame:
    """First request per actor and key is accepted, repeats are replays, other bodies conflicts.

    `requests`: request_id, actor_id, idempotency_key, body, requested_at. Requests
    without a key are all accepted.
    """
    keys = ["actor_id", "idempotency_key"]
    first = (
        requests.where(F.col("idempotency_key").isNotNull())
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct("request_id", "body"), F.struct("requested_at", "request_id")).alias("_first"),
        )
        .select(*keys, F.col("_first.request_id").alias("first_request_id"), F.col("_first.body").alias("_body"))
    )
    joined = lookup_join(requests, first, keys, ["request_id"], "left")
    is_first = F.col("idempotency_key").isNull() | (F.col("request_id") == F.col("first_request_id"))
    return joined.select(
        *requests.columns,
        F.coalesce("first_request_id", "request_id").alias("job_request_id"),
        F.when(is_first, "accepted")
        .when(F.col("body").eqNullSafe(F.col("_body")), "replayed")
        .otherwise("conflict")
        .alias("verdict"),
    )


def status_fold(log: DataFrame) -> DataFrame:
    """Current status of each axis, last error and stage to retry from, out of the event log.

    `log`: item_id, axis, stage, status, error_code, ts, event_id. The newest event per
    axis counts.
    """
    order = F.struct("ts", "event_id")
    failed = F.col("status") == "failed"

    def newest(value: str, condition: Column) -> Column:
        return F.max_by(F.col(value), F.when(condition, order))

    return log.groupBy("item_id").agg(
        *[F.coalesce(newest("status", F.col("axis") == a), F.lit("pending")).alias(a) for a in V.AXES],
        newest("error_code", failed).alias("error_code"),
        newest("stage", failed).alias("last_retryable_stage"),
    )


def terminal_outcome(facts: DataFrame) -> DataFrame:
    """Outcome of each item from what the steps found, first matching rule wins.

    `facts`: missing_annotations, readable, looks_like_image, parse_error, missing_tags,
    storage_error.
    """
    rules = [
        (F.coalesce("missing_annotations", F.lit("")) != "", "rejected", V.MISSING_ANNOTATION, F.col("missing_annotations")),
        (~F.col("readable"), "rejected", V.UNREADABLE, F.lit("")),
        (~F.col("looks_like_image"), "rejected", V.NOT_IMAGE, F.lit("DICOM magic not found at byte offset 128")),
        (F.col("parse_error").isNotNull(), "rejected", V.PARSE_FAILED, F.col("parse_error")),
        (
            F.coalesce("missing_tags", F.lit("")) != "", "rejected", V.MISSING_TAG,
            F.concat(F.lit("Missing required tags: "), F.col("missing_tags")),
        ),
        (F.col("storage_error").isNotNull(), "failed", V.STORAGE_FAILED, F.col("storage_error")),
    ]
    outcome = code = detail = None
    for condition, result, error, text in rules:
        outcome = F.when(condition, result) if outcome is None else outcome.when(condition, result)
        code = F.when(condition, error) if code is None else code.when(condition, error)
        detail = F.when(condition, text) if detail is None else detail.when(condition, text)
    return facts.select(
        "*",
        outcome.otherwise("accepted").alias("outcome"),
        code.otherwise("").alias("error_code"),
        detail.otherwise("").alias("error_detail"),
    )


def outcome_conflicts(log: DataFrame) -> DataFrame:
    """Attempts to change an outcome that was set before, counted per item and outcome.

    Aggregated first per item and outcome, so the second step sees at most one row per
    outcome and no item's log is ever gathered in one place.
    """
    order = F.struct("ts", "event_id")
    per_outcome = (
        log.where(F.coalesce("outcome", F.lit("")) != "")
        .groupBy("item_id", "outcome")
        .agg(F.min(order).alias("_since"), F.count(F.lit(1)).alias("attempts"))
    )
    first = per_outcome.groupBy("item_id").agg(F.min_by("outcome", "_since").alias("first_outcome"))
    return per_outcome.join(first, "item_id").where(F.col("outcome") != F.col("first_outcome")).select(
        "item_id", "first_outcome", F.col("outcome").alias("refused_outcome"), "attempts"
    )


def close_axes(items: DataFrame) -> DataFrame:
    """Rejected items: axes still pending, other than the scan, become rejected."""
    rejected = F.col("outcome") == "rejected"
    closed = {
        a: F.when(rejected & (F.col(a) == "pending"), "rejected").otherwise(F.col(a)) for a in V.AXES[1:]
    }
    return items.withColumns(closed)


def item_flags(items: DataFrame) -> DataFrame:
    outcome = F.coalesce("outcome", F.lit(""))
    return items.select(
        "*",
        all_completed().alias("all_completed"),
        any_failed().alias("any_failed"),
        F.when(outcome == "failed", F.coalesce("last_retryable_stage", F.lit("")) != "")
        .when(outcome != "", False)
        .otherwise(any_failed())
        .alias("can_retry"),
    )


def transition_check(states: DataFrame) -> DataFrame:
    """State changes of jobs that the allowed transitions do not cover.

    `states`: job_id, ts, event_id, state. A job starts as created; repeating a state is
    allowed. A busy job is compared second by second.
    """
    second = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    seen = previous_row(states, ["job_id"], ["ts", "event_id"], "state", second, "from_state")
    seen = seen.withColumn("from_state", F.coalesce("from_state", F.lit("created")))
    allowed = F.create_map(
        *[
            x
            for state, targets in V.JOB_TRANSITIONS.items()
            for x in (F.lit(state), F.array(*[F.lit(t) for t in targets]).cast("array<string>"))
        ]
    )
    same = F.col("from_state") == F.col("state")
    ok = F.coalesce(F.array_contains(allowed[F.col("from_state")], F.col("state")), F.lit(False))
    return seen.where(~same & ~ok).select("job_id", "event_id", "from_state", F.col("state").alias("to_state"))


def accept_items(items: DataFrame, attempts: DataFrame) -> DataFrame:
    """Items whose attempt belongs to the same job are accepted, the others are errors."""
    known = attempts.select("attempt_id", "job_id", F.lit(True).alias("_same_job"))
    return items.join(known, ["attempt_id", "job_id"], "left").select(
        "item_id", "attempt_id", "job_id",
        F.when(F.col("_same_job"), "accepted").alias("outcome"),
        F.when(F.col("_same_job").isNull(), "AttemptOfOtherJob").alias("error_code"),
    )


def item_status() -> Column:
    """Outcome if there is one, else what the axes say."""
    return (
        F.when(F.coalesce("outcome", F.lit("")) != "", F.col("outcome"))
        .when(all_completed(), "completed")
        .when(any_failed(), "failed")
        .otherwise("in_progress")
    )
