"""Operational metrics over the event log: counts, histograms, rates, lag, alerts, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.functions import values as V


def success_label() -> Column:
    return F.when(F.col("status") == "completed", "success").otherwise(F.col("status"))


def stage_counts(events: DataFrame) -> DataFrame:
    """Events by stage and status."""
    return events.groupBy("stage", success_label().alias("status")).agg(F.count(F.lit(1)).alias("n"))


def job_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def stage_errors(events: DataFrame) -> DataFrame:
    failed = events.where((F.col("status") == "failed") & F.col("error_code").isNotNull())
    return failed.groupBy("stage", "error_code").agg(F.count(F.lit(1)).alias("n"))


def _bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    return [F.count_if(value <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)]


def histogram(df: DataFrame, labels: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative bucket counts, sum and count per label set, one row per bucket.

    The open bucket has the bound `+Inf`. Sums are taken in decimals, so the order of
    rows does not show in them.
    """
    wide = df.where(F.col(value).isNotNull()).groupBy(*labels).agg(
        *_bucket_counts(F.col(value), bounds),
        F.sum(F.col(value).cast("decimal(28,6)")).cast("double").alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_le_{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("n").alias("cumulative")))
    return wide.select(*labels, "total", "n", F.inline(F.array(*rows)))


def histogram_quantile(
    df: DataFrame, labels: Sequence[str], value: str, bounds: Sequence[float], quantile: float
) -> DataFrame:
    """Quantile per label set, interpolated inside its bucket; the open bucket gives the last bound."""
    wide = df.where(F.col(value).isNotNull()).groupBy(*labels).agg(
        *_bucket_counts(F.col(value), bounds), F.count(F.lit(1)).alias("n")
    )
    rank = F.lit(quantile) * F.col("n")
    result = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = float(bounds[i - 1]) if i else 0.0
        below = F.col(f"_le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"_le_{i}") - below
        estimate = F.when(inside == 0, F.lit(float(bounds[i]))).otherwise(
            F.lit(low) + F.lit(float(bounds[i]) - low) * ((rank - below) / inside)
        )
        result = F.when(F.col(f"_le_{i}") >= rank, estimate).otherwise(result)
    return wide.select(*labels, "n", result.alias("estimate"))


def rate(events: DataFrame, labels: Sequence[str], window: str = "5 minutes", slide: str = "1 minute", seconds: int = 300) -> DataFrame:
    """Events per second in sliding windows."""
    return (
        events.groupBy(F.window("ts", window, slide).alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), *labels, "n", (F.col("n") / seconds).alias("per_second"))
    )


def stuck_items(items: DataFrame, as_of: Column, minutes: int = 10) -> DataFrame:
    """Items in progress at some stage and untouched for `minutes` before `as_of`."""
    stage = F.coalesce(
        *[F.when(F.col(a) == "in_progress", F.lit(s)) for a, s in zip(V.AXES, V.REPLAY_STAGES)]
    )
    return items.withColumn("stage", stage).where(
        F.col("stage").isNotNull() & (F.col("updated_at") < as_of - F.expr(f"INTERVAL {minutes} MINUTES"))
    )


def index_lag(events: DataFrame) -> DataFrame:
    """Seconds from the first persistence of an item to its first indexing, where in that order."""
    first = events.groupBy("item_id").agg(
        F.min(F.when(F.col("stage") == "metadata_persistence", F.col("ts"))).alias("_persisted"),
        F.min(F.when(F.col("stage") == "indexing", F.col("ts"))).alias("_indexed"),
    )
    micros = F.unix_micros(F.col("_indexed").cast("timestamp")) - F.unix_micros(F.col("_persisted").cast("timestamp"))
    return first.where(F.col("_indexed") >= F.col("_persisted")).select("item_id", (micros / 1000000).alias("lag_seconds"))


def recovery_time(replays: DataFrame) -> DataFrame:
    """Replays by outcome with their mean duration."""
    status = F.when(F.col("success"), "success").otherwise("failed")
    total = F.sum(F.col("duration_ms").cast("decimal(28,6)")).cast("double")
    return replays.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"), (total / F.count("duration_ms")).alias("mean_ms")
    )


def recovery_histogram(replays: DataFrame) -> DataFrame:
    """Cumulative buckets of the duration of replays."""
    return histogram(replays, [], "duration_ms", V.RECOVERY_BUCKETS_MS)


def alert_rules(events: DataFrame, items: DataFrame, as_of: Column) -> DataFrame:
    """Value and level of each alert rule, and the worst of them as `overall`.

    Error rate over 5 % is P2, from 1 % P3; a lag over 60 s and stuck items are P3.
    """
    error_rate = events.agg((F.count_if(F.col("status") == "failed") / F.count(F.lit(1))).alias("value"))
    lag = index_lag(events).agg(F.coalesce(F.max("lag_seconds"), F.lit(0.0)).alias("value"))
    stuck = stuck_items(items, as_of).agg(F.count(F.lit(1)).cast("double").alias("value"))
    value = F.col("value")
    rules = (
        error_rate.select(F.lit("error_rate").alias("rule"), "value", F.when(value > 0.05, 2).when(value >= 0.01, 3).otherwise(9).alias("_p"))
        .unionByName(lag.select(F.lit("index_lag").alias("rule"), "value", F.when(value > 60, 3).otherwise(9).alias("_p")))
        .unionByName(stuck.select(F.lit("stuck_items").alias("rule"), "value", F.when(value > 0, 3).otherwise(9).alias("_p")))
    )
    overall = rules.agg(F.min("_p").alias("_p")).select(F.lit("overall").alias("rule"), F.lit(None).cast("double").alias("value"), "_p")
    level = F.when(F.col("_p") == 9, "ok").otherwise(F.concat(F.lit("P"), F.col("_p").cast("string")))
    return rules.unionByName(overall).select("rule", "value", level.alias("level"))


def alert_episodes(
    events: DataFrame, labels: Sequence[str] = (), threshold: float = 0.01, window_seconds: int = 60, hold_seconds: int = 120, as_of: Column | None = None
) -> DataFrame:
    """Stretches of time in which the error rate stays over `threshold` for `hold_seconds` or longer.

    Events are counted per window first; a window without events has no rate and ends a stretch. Windows over
    the threshold that follow each other are one episode: from the start of its first to the end
    of its last window, with its events, failures and worst rate. With `as_of` only windows that
    have ended by then count. What is ordered is windows, a row each, not events.
    """
    size = f"{window_seconds} seconds"
    rates = (
        events.groupBy(F.window("ts", size).alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed").alias("n_failed"))
        .select(*labels, F.col("w.start").alias("_start"), F.col("w.end").alias("_end"), "n", "n_failed", (F.col("n_failed") / F.col("n")).alias("rate"))
    )
    if as_of is not None:
        rates = rates.where(F.col("_end") <= as_of)
    over = rates.where(F.col("rate") > threshold)
    number = F.floor(F.unix_seconds(F.col("_start").cast("timestamp")) / window_seconds)
    place = F.row_number().over(Window.partitionBy(*labels).orderBy("_start")) if labels else F.row_number().over(Window.orderBy("_start"))
    return (
        over.withColumn("_island", number - place)
        .groupBy(*labels, "_island")
        .agg(
            F.min("_start").alias("started_at"), F.max("_end").alias("ended_at"), F.count(F.lit(1)).alias("n_windows"),
            F.sum("n").alias("n"), F.sum("n_failed").alias("n_failed"), F.max("rate").alias("worst_rate"),
        )
        .where(F.col("n_windows") * window_seconds >= hold_seconds)
        .drop("_island")
    )


def sketch_rank_error(k: int) -> float:
    """Rank error of a sketch of size `k`, as a share of the values, that 99 of 100 sketches keep."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, labels: Sequence[str], value: str, window: str = "5 minutes", k: int = 800) -> DataFrame:
    """A quantile sketch of `value` per label set and window of `ts`: window_start, labels, n, sketch.

    A sketch has a fixed size however many values it has seen, and is built map-side; those of
    any windows can be merged, so a stored table of them answers for every span without the events.
    """
    seen = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k))
    grouped = seen.groupBy(F.window("ts", window).alias("w"), *labels).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch"))
    return grouped.select(F.col("w.start").alias("window_start"), *labels, "n", "sketch")


def sketch_quantiles(sketches: DataFrame, labels: Sequence[str], quantiles: Sequence[float], start=None, end=None) -> DataFrame:
    """Quantiles per label set over the windows from `start` to before `end`: labels, n, quantile, estimate, one row each.

    Estimates are off by `sketch_rank_error` of the sketches' size in rank, whatever the number of merges.
    """
    if start is not None:
        sketches = sketches.where(F.col("window_start") >= start)
    if end is not None:
        sketches = sketches.where(F.col("window_start") < end)
    merged = sketches.groupBy(*labels).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_s")).where("n > 0")
    rows = [F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias("estimate")) for q in quantiles]
    return merged.select(*labels, "n", F.inline(F.array(*rows)))


def audit_log(actions: DataFrame) -> DataFrame:
    """Audit rows (actor_id, action, resource_type, resource_id, sensitive_fields, success) with the access flag."""
    return actions.withColumn("sensitive_accessed", F.size("sensitive_fields") > 0)


def audit_access_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("actor_id", "action").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("sensitive_accessed").alias("n_sensitive"),
        F.count_if(~F.col("success")).alias("n_failed"),
    )
