"""Edges resolved by arrivals alone, episodes of alerts, merged sketches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from obsledger.operators import metrics as M
from obsledger.operators import references as R
from tests.conftest import rows

INSTANCE = "sop_instance_uid string, series_instance_uid string, study_instance_uid string"
EDGES = "from_sop string, relationship string, to_study string, to_series string, to_sop string, frame_number int"


@pytest.mark.parametrize(("seed", "bits"), [(1, 1 << 23), (2, 1 << 23), (3, 4)])
def test_delta_equals_full_resolution(spark, seed, bits, monkeypatch):
    """Any order of arrival; a filter that is far too small costs work, no edge."""
    monkeypatch.setattr(R.may_have_target, "__defaults__", (bits,))
    r = random.Random(seed)
    instances = [(f"i{n}", f"s{n // r.choice([1, 2])}", f"t{n // 5}") for n in range(40)]
    some = lambda kind, n: r.choice([None, f"{kind}{r.randrange(n)}"])
    edges = spark.createDataFrame([(f"e{n}", "r", some("t", 12), some("s", 45), some("i", 60), None) for n in range(80)], EDGES)
    frame = lambda part: spark.createDataFrame(part, INSTANCE)
    r.shuffle(instances)
    held = instances[:10]
    state = R.refs_resolve(edges, frame(held))
    counts = R.candidate_counts(frame(held))
    for cut in (11, 25, 40):
        arrivals = instances[len(held) : cut]
        again, touched = R.edges_reresolve_delta(state, counts, frame(arrivals))
        held = instances[:cut]
        want = R.edges_reresolve(state, frame(held))
        columns = [*R.EDGE, "resolved_sop", "resolution_path"]
        assert rows(again, *columns) == rows(want, *columns)
        counts = R.candidate_counts(frame(held))
        assert rows(touched) == rows(counts.join(touched.select("level", "uid"), ["level", "uid"], "left_semi"))
        state = R.refs_resolve(edges, frame(held))


def test_the_filter_picks_few_edges(spark):
    edges = spark.range(5000).select(F.concat(F.lit("i"), "id").alias("to_sop"), F.lit(None).cast("string").alias("to_series"), F.lit(None).cast("string").alias("to_study"))
    keys = spark.createDataFrame([("to_sop", f"i{n}") for n in range(0, 5000, 100)], "level string, uid string")
    picked = {r["to_sop"] for r in edges.where(R.may_have_target(keys)).collect()}
    assert {f"i{n}" for n in range(0, 5000, 100)} <= picked and len(picked) < 60
    assert edges.where(R.may_have_target(keys.where("false"))).count() == 0


def test_episodes(spark):
    def at(minute, status, n=1):
        return [(dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute, seconds=k), status) for k in range(n)]

    log = at(0, "failed") + at(1, "completed", 50) + at(2, "failed") + at(3, "failed", 2) + at(3, "completed", 2) + at(4, "failed") + at(6, "failed") + at(7, "completed", 9) + at(8, "failed") + at(9, "failed")
    events = spark.createDataFrame(log, "ts timestamp_ntz, status string")
    got = rows(M.alert_episodes(events), "started_at", "ended_at", "n_windows", "n", "n_failed", "worst_rate")
    clock = lambda m: dt.datetime(2024, 1, 1, 0, m)
    assert got == [(clock(2), clock(5), 3, 6, 4, 1.0), (clock(8), clock(10), 2, 2, 2, 1.0)]
    early = M.alert_episodes(events, as_of=F.lit("2024-01-01 00:04:30").cast("timestamp_ntz"))
    assert rows(early, "started_at", "ended_at") == [(clock(2), clock(4))]
    assert M.alert_episodes(events, hold_seconds=180).count() == 1 and M.alert_episodes(events.where("false")).count() == 0
    assert M.alert_episodes(events, threshold=1.0).count() == 0


def test_sketches_keep_the_rank_error(spark):
    events = spark.range(60_000).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 7200)")).alias("ts"), (F.col("id") % 2).alias("stage"),
        F.when(F.col("id") % 97 != 0, F.pow(F.pmod(F.xxhash64("id"), F.lit(9973)) / 9973, F.lit(3)) * 1000).alias("ms"),
    )
    sketches = M.quantile_sketches(events, ["stage"], "ms")
    assert sketches.count() == 2 * 24
    for start, end in ((None, None), ("2024-01-01 00:30:00", "2024-01-01 01:10:00")):
        span = events.where("ms IS NOT NULL")
        if start:
            span = span.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
        bounds = [None if t is None else F.lit(t).cast("timestamp_ntz") for t in (start, end)]
        found = M.sketch_quantiles(sketches, ["stage"], [0.01, 0.5, 0.99], *bounds).collect()
        assert len(found) == 6
        for r in found:
            values = span.where(F.col("stage") == r["stage"])
            n, upto = values.agg(F.count("*"), F.count_if(F.col("ms") <= r["estimate"])).first()
            assert n == r["n"] and abs(upto / n - r["quantile"]) <= 2 * M.sketch_rank_error(800) + 1 / 9973
    assert M.sketch_quantiles(M.quantile_sketches(events.where("false"), ["stage"], "ms"), ["stage"], [0.5]).count() == 0
