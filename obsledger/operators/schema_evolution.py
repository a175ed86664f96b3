"""Versions of the tag schema: compatibility, stale series, re-parse queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.paging import limited


def _part(version: Column, position: int) -> Column:
    """Numeric part of `x.y.z`, 0 where it is missing."""
    return F.coalesce(F.try_element_at(F.split(version, r"\."), F.lit(position)), F.lit("0")).cast("int")


def schema_compat(pairs: DataFrame) -> DataFrame:
    """Level and reason for each pair of versions.

    `pairs`: old_version, new_version and the arrays old_required, old_optional,
    new_required. Another major version is incompatible; a higher minor one needs a
    re-parse when a field is newly required.
    """
    old, new = F.col("old_version"), F.col("new_version")
    added = F.array_sort(F.array_except("new_required", "old_required"))
    minor_up = _part(new, 2) > _part(old, 2)
    level = (
        F.when(_part(new, 1) != _part(old, 1), "incompatible")
        .when(minor_up & (F.size(added) > 0), "requires_reparse")
        .otherwise("compatible")
    )
    reason = (
        F.when(_part(new, 1) != _part(old, 1), F.concat(F.lit("Major version changed: "), old, F.lit(" -> "), new))
        .when(minor_up & (F.size(added) > 0), F.concat(F.lit("New required fields added: "), F.array_join(added, ", ")))
        .when(minor_up, F.lit("Minor version with only optional additions"))
        .when(_part(new, 3) > _part(old, 3), F.lit("Patch version change only"))
        .otherwise(F.lit("Same version"))
    )
    return pairs.select("old_version", "new_version", level.alias("level"), reason.alias("reason"))


def stale_by_version(series: DataFrame, compat: DataFrame) -> DataFrame:
    """Current series whose stored version is not compatible become stale and need a re-parse.

    `compat` holds the registered versions against the current one; a version it does not have
    cannot be judged and counts as not compatible, with level `unknown`. Rows that are not
    current keep their status, reason and mark, so marking twice is marking once. `level` is
    that of the row's version. `compat` is as small as the registry, and adaptive execution
    broadcasts it only if its measured size allows.
    """
    known = compat.select(
        F.col("old_version").alias("extracted_schema_version"), F.col("level").alias("_level"), F.col("reason").alias("_reason")
    )
    level = F.coalesce("_level", F.lit("unknown"))
    missing = F.concat(F.lit("Schema definition not found for "), F.coalesce("extracted_schema_version", F.lit("no version")))
    hit = (F.col("projection_status") == "current") & (level != "compatible")
    before = {
        "stale_reason": F.col("stale_reason") if "stale_reason" in series.columns else F.lit(None).cast("string"),
        "needs_reparse": F.coalesce("needs_reparse", F.lit(False)) if "needs_reparse" in series.columns else F.lit(False),
    }
    kept = [c for c in series.columns if c not in ("projection_status", "stale_reason", "needs_reparse", "level")]
    return series.join(known, "extracted_schema_version", "left").select(
        *kept,
        F.when(hit, "stale").otherwise(F.col("projection_status")).alias("projection_status"),
        F.when(hit, F.coalesce("_reason", missing)).otherwise(before["stale_reason"]).alias("stale_reason"),
        F.when(hit, True).otherwise(before["needs_reparse"]).alias("needs_reparse"),
        level.alias("level"),
    )


def stale_counters(marked: DataFrame) -> DataFrame:
    """Series per compatibility level."""
    return marked.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def reparse_queue(marked: DataFrame, limit: int | None = None) -> DataFrame:
    """Stale series to parse again, CT and MR first, longest stale first; all or the first `limit`."""
    first = F.when(F.col("modality").isin("CT", "MR"), 1).otherwise(2)
    queue = marked.where("needs_reparse AND projection_status = 'stale'").orderBy(first, "updated_at", "series_instance_uid")
    return limited(queue, limit)


def reparse_mark(marked: DataFrame, results: DataFrame, new_version: str) -> DataFrame:
    """Series after re-parsing; `results`: series_instance_uid, success, one row per series."""
    done = results.select("series_instance_uid", F.col("success").alias("_ok"))
    ok, failed = F.coalesce("_ok", F.lit(False)), ~F.coalesce("_ok", F.lit(True))
    changed = {
        "projection_status": F.when(ok, "current").when(failed, "reparse_failed").otherwise(F.col("projection_status")),
        "stale_reason": F.when(failed, "reparse_error").when(~ok, F.col("stale_reason")),
        "needs_reparse": F.when(ok, False).otherwise(F.col("needs_reparse")),
        "extracted_schema_version": F.when(ok, new_version).otherwise(F.col("extracted_schema_version")),
        "reparse_error_count": F.col("reparse_error_count") + F.when(failed, 1).otherwise(0),
    }
    return marked.join(done, "series_instance_uid", "left").withColumns(changed).drop("_ok")


def reparse_stats(series: DataFrame) -> DataFrame:
    return series.agg(
        F.count(F.lit(1)).alias("total_series"),
        F.count_if(F.col("projection_status") == "stale").alias("stale_count"),
        F.count_if(F.col("projection_status") == "reparse_failed").alias("failed_count"),
        F.count_if("needs_reparse").alias("pending_reparse"),
    )
