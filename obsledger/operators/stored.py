"""The read model, findings and edges as stored tables: pages, merges and rebuilds that touch only what they must."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.operators.duplicates import FINDING, findings_upsert
from obsledger.operators.projection import PROJECTION, Scope, projection_filter, projection_merge, projection_stale, rebuild_select, reindex_plan, reindex_verify
from obsledger.operators.references import EDGE, edge_key, edges_upsert
from obsledger.sources.buckets import BucketTable

YEAR = "study_year"


def with_year(projections: DataFrame) -> DataFrame:
    """Read model rows as they are stored: with the year of the study, by which files are parted."""
    return projections.withColumn(YEAR, F.year(F.col("study_date").cast("date")))


def _years(filters: dict) -> Column:
    """What a range of study dates says about the year, so that folders of other years are not opened."""
    low, high = (filters.get(f"study_date_{end}") for end in ("from", "to"))
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(YEAR) >= int(str(low)[:4]))
    if high is not None:
        inside = inside & (F.col(YEAR) <= int(str(high)[:4]))
    return inside


def stored_rows(table: BucketTable, buckets: Sequence[int] | None = None, **filters) -> DataFrame:
    """Stored read model rows that pass `filters` (`projection_filter`), read with pruned folders and pushed filters."""
    return projection_filter(table.read(buckets).where(_years(filters)), **filters)


def stored_page(table: BucketTable, per_page: int, after: str | None = None, **filters) -> DataFrame:
    """The `per_page` matching rows behind the key `after`, by key; the last one's key is the cursor of the next page.

    Buckets follow the order of keys: reading starts in the bucket of the cursor and goes on, by twice as many
    buckets each time, only until the page is full. Pages cost what they show, wherever they begin.
    """
    start, last = table.bucket_of(after) if after else 0, table.buckets - 1
    behind = F.col(table.key) > F.lit(after) if after else F.lit(True)
    have, low, high, step = 0, start, start, 1
    while True:
        have += stored_rows(table, range(low, high + 1), **filters).where(behind).limit(per_page - have).count()
        if have >= per_page or high >= last:
            break
        low, high, step = high + 1, min(last, high + step), 2 * step
    return stored_rows(table, range(start, high + 1), **filters).where(behind).orderBy(table.key).limit(per_page)


def merge_projections(table: BucketTable, fresh: DataFrame) -> list[int]:
    """`projection_merge` into the stored read model; the buckets rewritten."""

    def changed(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return projection_stale(batch, stored).where("state <> 'current'").select(PROJECTION)

    return table.merge(fresh.select(PROJECTION), changed, lambda stored, news: with_year(projection_merge(news, stored)))


def merge_findings(table: BucketTable, new: DataFrame) -> list[int]:
    """`findings_upsert` into stored findings: those not held yet are added; the buckets rewritten."""

    def changed(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return batch.join(stored.select("finding_id"), "finding_id", "left_anti").select(FINDING)

    return table.merge(new.select(FINDING), changed, findings_upsert)


def merge_edges(table: BucketTable, new: DataFrame) -> list[int]:
    """`edges_upsert` into stored edges: a repeated edge takes the newer target and status; the buckets rewritten."""
    values = [*EDGE, "status", "resolved_sop"]
    keyed = edges_upsert(new.where("false"), new)  # one row per key

    def changed(stored: DataFrame, batch: DataFrame) -> DataFrame:
        held = stored.select("edge_id", F.struct(values).alias("_held"))
        return batch.join(held, "edge_id", "left").where(~F.struct(values).eqNullSafe(F.col("_held"))).select(batch.columns)

    return table.merge(keyed, changed, edges_upsert)


def rebuild_stored(
    table: BucketTable, job: str, instances: DataFrame, fresh: DataFrame, scope: Scope = Scope(), buckets_at_once: int = 8
) -> DataFrame:
    """Rebuild the read model's rows in scope, some buckets at a time; one row per step, as `reindex_run` has them.

    The rebuilt rows are staged once, below the table and by the job's name. Every group of buckets is one
    commit under that name, so a job that is run again after a failure takes its staged rows and goes on
    behind the buckets it has finished; those it has no rows for are not touched. What was
    rebuilt is counted while it is written.
    """
    stored = table.read()
    plan = reindex_plan(instances, stored, scope).select(
        F.lit(1).alias("step_no"), F.lit("analyze").alias("step"), F.lit("success").alias("status"),
        F.col("affected_instances").alias("n"), F.col("warnings").alias("message"),
    )
    staged = replace(table, path=f"{table.path}/jobs/{job}", parts=())
    if not staged.exists():
        chosen = rebuild_select(instances, stored, scope, force=True)
        staged.create(fresh.join(chosen, "sop_instance_uid", "left_semi").select(PROJECTION))
    rows = {bucket: commit[2] for bucket, commit in staged.live().items() if commit[2]}
    finished = {r[0] for r in table.commits().where(F.col("job") == job).select("bucket").distinct().collect()}
    left = sorted(set(rows) - finished)
    for start in range(0, len(left), buckets_at_once):
        part = left[start : start + buckets_at_once]
        new = staged.read(part)
        kept = table.read(part).select(PROJECTION).join(new.select("instance_id"), "instance_id", "left_anti").select(PROJECTION)
        table.replace(with_year(kept.unionByName(new)), part, job)
    n = sum(rows.values())
    spark = table.spark
    rebuilt = spark.createDataFrame([(2, "rebuild_projections", "success", n, f"Rebuilt {n} projections")], "step_no int, step string, status string, n bigint, message string")
    verify = reindex_verify(scope.apply(instances), table.read()).select(
        F.lit(3).alias("step_no"), F.lit("verify").alias("step"), "status", F.col("instances_without_projections").alias("n"),
        F.concat(F.col("instances_without_projections").cast("string"), F.lit(" instances missing projections")).alias("message"),
    )
    return plan.unionByName(rebuilt).unionByName(verify)


def open_table(spark, path: str, kind: str, buckets: int = 64) -> BucketTable:
    """The stored table of a kind: `projections`, `findings` or `edges`."""
    key, parts = {"projections": ("instance_id", (YEAR,)), "findings": ("finding_id", ()), "edges": ("edge_id", ())}[kind]
    return BucketTable(spark, path, key, buckets, parts)


def edges_with_key(edges: DataFrame) -> DataFrame:
    """Edges as they are stored."""
    return edges.select(edge_key().alias("edge_id"), *EDGE, "status", "resolved_sop")
