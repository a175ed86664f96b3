"""Streams give what the batch operators give, whatever the batches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from obsledger.operators import canonical as C
from obsledger.operators import duplicates as D
from obsledger.plans import QUERIES
from obsledger.plans import fixtures as X
from obsledger.streaming import ingest, metrics
from tests.conftest import rows


@pytest.fixture(scope="module")
def observations(spark, sf_dir):
    return X.observations(spark, sf_dir).select("observation_id", "sop_instance_uid", "observed_at", "whole_file_sha256").cache()


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [1, 2, 0]])
def test_ingest_in_batches_equals_one_batch(spark, observations, tmp_path, order):
    """Parts of the ledger arrive in any order, one of them twice."""
    source = str(tmp_path / "in")
    years = F.year("observed_at")
    spans = [(0, 1995), (1996, 1998), (1999, 3000)]
    for i in [*order, order[0]]:
        observations.where(years.between(*spans[i])).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(observations.schema).option("maxFilesPerTrigger", 1).parquet(source)
    ledger = str(tmp_path / "ledger")
    ingest.stream_ingest(stream, ledger, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(f"{ledger}/observations").select(ingest.BATCH).distinct().count() > 1
    state = ingest.ledger_state(spark, ledger)
    assert rows(state, "observation_id", "is_canonical") == rows(C.canonical_select(observations), "observation_id", "is_canonical")
    assert rows(ingest.ledger_findings(spark, ledger), "finding_id") == rows(D.identity_duplicates(observations), "finding_id")


def test_repeating_a_batch_changes_nothing(spark, observations, tmp_path):
    ledger = str(tmp_path / "ledger")
    early, late = observations.where("observed_at < '1997-01-01'"), observations.where("observed_at >= '1997-01-01'")
    ingest.process_batch(early, 0, ledger)
    ingest.process_batch(late, 1, ledger)
    before = rows(spark.read.parquet(f"{ledger}/pointers")), rows(ingest.ledger_findings(spark, ledger), "finding_id")
    ingest.process_batch(late, 1, ledger)
    assert before == (rows(spark.read.parquet(f"{ledger}/pointers")), rows(ingest.ledger_findings(spark, ledger), "finding_id"))


@pytest.mark.parametrize("seed", [1, 2])
def test_compaction_changes_no_answer(spark, observations, tmp_path, monkeypatch, seed):
    """Batches in any order, some rows and some batches twice; compactions between, one of them killed."""
    ledger, r = str(tmp_path / "ledger"), random.Random(seed)
    parts = [observations.where(F.pmod(F.xxhash64("observation_id"), F.lit(6)).isin(i, (i + 1) % 6)) for i in range(6)]
    order = [r.randrange(6) for _ in range(3)] + r.sample(range(6), 6)
    seen = set()
    for no, i in enumerate(order):
        ingest.process_batch(parts[i], no, ledger)
        seen |= {i, (i + 1) % 6}
        if no == 4:
            with monkeypatch.context() as patched:
                patched.setattr(ingest, "_next_version", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
                with pytest.raises(KeyboardInterrupt):
                    ingest.compact(spark, ledger, 2)
        if no in (3, 4, 6, 8):
            ingest.compact(spark, ledger, 2)
    assert seen == set(range(6))
    ingest.process_batch(parts[order[2]], 2, ledger)  # an old batch once more
    levels = [level for _, level, _ in ingest._runs(spark, ledger)]
    assert max(levels) >= 1 and all(levels.count(x) < 2 for x in levels)
    state = ingest.ledger_state(spark, ledger)
    assert rows(state, "observation_id", "is_canonical") == rows(C.canonical_select(observations), "observation_id", "is_canonical")
    assert rows(ingest.ledger_findings(spark, ledger), "finding_id") == rows(D.identity_duplicates(observations), "finding_id")


def test_folders_read_do_not_grow_with_batches(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    rows_of = lambda no: spark.createDataFrame([(f"o{no}", f"s{no % 3}", dt.date(2024, 1, 1), "h")], "observation_id string, sop_instance_uid string, observed_at date, whole_file_sha256 string")
    for no in range(17):
        ingest.process_batch(rows_of(no), no, ledger)
        ingest.compact(spark, ledger, 4)
        waiting = spark.read.parquet(f"{ledger}/pointers").where(F.col(ingest.BATCH) > ingest._compacted_to(ingest._runs(spark, ledger)))
        assert len(ingest._runs(spark, ledger)) <= 2 * 3 and waiting.select(ingest.BATCH).distinct().count() < 4
    assert ingest.ledger_observations(spark, ledger).count() == 17 and ingest.ledger_pointers(spark, ledger).count() == 3


@pytest.mark.parametrize("name", ["stream_ingest", "stream_metrics", "stream_dedupe"])
def test_queries_do_not_depend_on_the_files(spark, sf_dir, tmp_path, name):
    """The same rows in a folder of files that are cut by time and lie out of order."""
    for table, cut in (("events", F.expr("ntile(4) OVER (ORDER BY ts)")), ("lineitem", F.expr("ntile(4) OVER (ORDER BY l_shipdate)")), ("orders", F.lit(3))):
        parts = spark.read.parquet(f"{sf_dir}/{table}.parquet").withColumn("_cut", cut).cache()
        for i in (3, 1, 4, 2):
            parts.where(F.col("_cut") == i).drop("_cut").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{table}.parquet")
        parts.unpersist()
    assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, sf_dir))


def test_stream_of_a_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        X.table_stream(spark, str(tmp_path), "events")


def _write_events(spark, folder, name, events):
    df = spark.createDataFrame(events, "ts timestamp, status string, n int")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df


def test_rate_drops_late_events(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    folder = str(tmp_path / "in")
    _write_events(spark, folder, "1", [(at(10, 0), "failed", 1), (at(10, 1), "completed", 2), (at(12, 0), "completed", 3)])
    first = spark.readStream.schema("ts timestamp, status string, n int").parquet(folder)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    metrics.write_available(metrics.stream_rate(first, slide="5 minutes"), out, checkpoint).awaitTermination()
    _write_events(spark, folder, "2", [(at(10, 2), "completed", 4), (at(13, 0), "failed", 5)])
    metrics.write_available(metrics.stream_rate(first, slide="5 minutes"), out, checkpoint).awaitTermination()
    got = rows(spark.read.parquet(out), "window_start", "n", "n_failed")
    assert got == [(at(10, 0), 2, 1), (at(12, 0), 1, 0)]


def test_dedupe_counts_again_after_a_gap(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run(events):
        _write_events(spark, folder, "x", [(t, "s", n) for t, n in events])
        stream = spark.readStream.schema("ts timestamp, status string, n int").parquet(folder)
        items = stream.select("ts", F.col("n").alias("item_id"), F.lit("j").alias("job_id"), F.lit("k").alias("source_kind"),
                              F.col("n").cast("string").alias("source_path"), F.lit(1).alias("byte_size"))
        metrics.write_available(metrics.stream_dedupe(items), out, checkpoint).awaitTermination()

    run([(at(1), 7), (at(1, 30), 7), (at(1), 8)])
    run([(at(2, 20), 7), (at(9), 9)])
    run([(at(8, 30), 9), (at(10), 7), (at(20), 1)])  # half past eight is late, but not too late
    # 7 from one to twenty past two is one run, at ten another; the two nines are one, which begins at half past eight
    assert rows(spark.read.parquet(out), "item_id", "ts") == sorted([(7, at(1)), (7, at(10)), (8, at(1)), (9, at(8, 30))], key=repr)
