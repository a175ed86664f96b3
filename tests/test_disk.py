"""What queries leave on disk while they run: inputs of several branches are built once, shuffles go when a write ends."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from obsledger import session
from obsledger.functions import paths
from obsledger.operators import canonical as C
from obsledger.plans import QUERIES
from obsledger.sources.buckets import BucketTable
from obsledger.streaming import ingest, progress
from tests.conftest import rows


def shuffle_files(spark) -> int:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").splitlines()
    return sum(Path(n).name.startswith("shuffle_") for n in names)


def test_what_is_staged_gives_its_shuffles_back(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias("m"))
    want, setting = rows(df), spark.conf.get(session.GIVE_BACK, None)
    before = shuffle_files(spark)
    for _ in range(3):
        staged = session.staged(df, "test")
    for _ in range(50):  # they go in the background
        if (left := shuffle_files(spark)) <= before:
            break
        time.sleep(0.2)
    assert left <= before and rows(staged) == want and spark.conf.get(session.GIVE_BACK, None) == setting


@pytest.mark.parametrize(("name", "scans"), [
    ("projection_merge", 0),
    ("edges_upsert", 0),
    ("findings_upsert", 0), ("findings_read", 2), ("findings_resolve", 2), ("duplicate_summary", 1), ("duplicate_summary_by_instance", 1),
    ("projection_build", 0), ("projection_query", 0), ("projection_count", 0),
    ("reindex_run", 0),
    ("canonical_validate", 0), ("binding_apply", 0), ("binding_latest", 0),
    ("observation_diff", 0), ("ledger_invariants", 0), ("series_versions", 0), ("review_report", 0), ("path_version", 0),
])
def test_shared_inputs_are_built_once(spark, sf_dir, name, scans):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") <= scans


def test_a_merge_looks_for_changes_once(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path), "k", 4)
    made = lambda n, v: spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(v).alias("v"))
    table.create(made(40, 1))
    seen = []

    def combine(stored, news):
        seen.extend(news.inputFiles())
        return stored.join(news.select("k"), "k", "left_anti").unionByName(news)

    table.merge(made(5, 2), lambda stored, batch: batch.join(stored, ["k", "v"], "left_anti"), combine)
    assert seen and all("/changed/" in f for f in seen)
    assert rows(table.read(), "v").count((2,)) == 5 and table.read().count() == 40


def arrivals(spark, no, n=6):
    made = [(f"o{no}-{i}", f"s{i % 3}", dt.date(2024, 1, 1 + no), "h") for i in range(n)]
    return spark.createDataFrame(made, "observation_id string, sop_instance_uid string, observed_at date, whole_file_sha256 string")


def test_merged_batches_and_runs_are_cleared(spark, tmp_path):
    ledger, kept = str(tmp_path / "a"), str(tmp_path / "b")
    for no in range(7):
        for folder in (ledger, kept):
            ingest.process_batch(arrivals(spark, no), no, folder)
            if ingest.compact(spark, folder, 2) and folder == ledger:
                assert ingest.clear(spark, ledger) > 0
    assert ingest.clear(spark, ledger) == 0 and ingest.clear(spark, str(tmp_path / "c")) == 0
    assert len(list((tmp_path / "a/runs").iterdir())) == len(ingest._runs(spark, ledger)) < len(list((tmp_path / "b/runs").iterdir()))
    assert len(list((tmp_path / "a/observations").glob("batch_no=*"))) <= 2 < len(list((tmp_path / "b/observations").glob("batch_no=*")))
    for state in (ingest.ledger_state, ingest.ledger_findings):
        assert rows(state(spark, ledger)) == rows(state(spark, kept))
    ingest.process_batch(arrivals(spark, 0), 0, ledger)  # a merged batch once more
    assert rows(ingest.ledger_state(spark, ledger)) == rows(ingest.ledger_state(spark, kept))


def test_a_batch_is_computed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            calls.add(part.num_rows)
            yield part

    batch = arrivals(spark, 0)
    ingest.process_batch(batch.mapInArrow(seen, batch.schema), 0, str(tmp_path))
    assert calls.value == 6 and ingest.ledger_pointers(spark, str(tmp_path)).count() == 3
    ingest.process_batch(batch.where("false"), 1, str(tmp_path))
    assert ingest.ledger_observations(spark, str(tmp_path)).count() == 6


def test_first_arrivals_with_equal_days_and_ids(spark):
    """Keys and days may repeat: the least id of the first day, null before any other."""
    kind = "observation_id string, sop_instance_uid string, observed_at date"
    day = dt.date(2024, 1, 1)
    obs = spark.createDataFrame([("b", "s", day), ("a", "s", day), ("a", "s", day), (None, "t", day), ("c", "t", day), ("d", None, None)], kind)
    assert rows(C.canonical_pointers(obs)) == sorted([("s", "a", 3), ("t", None, 2), (None, "d", 1)], key=repr)


def test_repeated_events_meet_once(spark):
    at = dt.datetime(2024, 1, 1, 10)
    made = [(1, "metadata_persistence", at)] * 30 + [(1, "indexing", at + dt.timedelta(minutes=m)) for m in (5, 2) for _ in range(30)]
    lags = progress.index_lags(spark.createDataFrame(made, "item_id bigint, stage string, ts timestamp"))
    joined = lags._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert joined.count("Aggregate") == 2  # both sides
    assert [(r["item_id"], r["lag_seconds"]) for r in lags.collect()] == [(1, 120.0)]


def test_paths_that_fit_cost_no_further_step(spark):
    df = spark.createDataFrame([("a/b/c",), ("a/" + "1.2.840.10008.5.1.4.1.1.2/" * 4 + "x.dcm",), (None,)], "path string")
    short = paths.path_shorten(df, "path", "/srv/a", 78)
    plan = short._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN NOT (length(array_join(") >= 5
    assert [r["short_path"] for r in short.orderBy(F.length("path")).collect()][:2] == [None, "a/b/c"]
