"""Ledger operators over hand-made rows: conflicts, archives, schema versions, read model, lifecycle."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators import binding as B
from obsledger.operators import canonical as C
from obsledger.operators import conflicts as K
from obsledger.operators import duplicates as D
from obsledger.operators import lifecycle as L
from obsledger.operators import metrics as M
from obsledger.operators import projection as P
from obsledger.operators import replay
from obsledger.operators import schema_evolution as E
from obsledger.sources.archives import archive_safety
from tests.conftest import rows


@pytest.fixture(scope="module")
def classified(spark):
    stored = [("s1", f"i{n}", f"h{n}") for n in range(4)] + [("s2", "i9", None)] + [("s3", f"j{n}", "h") for n in range(20)]
    uploads = (
        [("new", "s0", "i0", "h0")]
        + [("exact", "s1", f"i{n}", f"h{n}") for n in range(4)] + [("exact", "s1", "i0", "h0")]
        + [("part", "s1", "i0", "h0"), ("part", "s1", "i1", "h1")]
        + [("diff", "s1", "i0", "other"), ("diff", "s1", "i1", "h1")]
        + [("uid", "s3", "j0", "h"), ("uid", "s3", "k1", "h")]
        + [("nohash", "s2", "i9", "x")]
    )
    return K.conflict_classify(
        spark.createDataFrame(uploads, "job_id string, series_instance_uid string, sop_instance_uid string, sha string"),
        spark.createDataFrame(stored, "series_instance_uid string, sop_instance_uid string, sha string"),
    )


def test_conflict_classes(classified):
    assert rows(classified, "job_id", "classification", "overlap_sop_count", "conflicting_sop_count", "uploaded_item_count", "uploaded_sop_count") == [
        ("diff", "content_conflict", 2, 1, 2, 2), ("exact", "exact_duplicate", 4, 0, 5, 4), ("new", "none", 0, 0, 1, 1),
        ("nohash", "exact_duplicate", 1, 0, 1, 1), ("part", "partial_overlap", 2, 0, 2, 2), ("uid", "uid_conflict", 1, 0, 2, 2),
    ]


def test_conflict_summary_and_queue(classified):
    summaries = K.conflict_summary(classified)
    assert rows(summaries, "job_id", "status", "severity", "new_sop_count", "missing_sop_count") == [
        ("diff", "open", "critical", 0, 2), ("exact", "auto_deduped", "info", 0, 0), ("nohash", "auto_deduped", "info", 0, 0),
        ("part", "open", "warning", 0, 2), ("uid", "open", "critical", 1, 19),
    ]
    assert [r["job_id"] for r in K.conflict_queue(summaries).collect()] == ["uid", "diff", "part"]


def test_conflict_decisions_in_order(spark, classified):
    summaries = K.conflict_summary(classified)
    ids = {r["job_id"]: r["attempt_id"] for r in classified.select("job_id", "attempt_id").collect()}
    log = [
        ("diff", 1, "merge"), ("diff", 2, "keep_existing"), ("diff", 3, "keep_existing"), ("diff", 4, "promote_uploaded"),
        ("diff", 5, "merge"), ("exact", 1, "keep_existing"), ("new", 1, "keep_existing"), ("uid", 1, "promote_uploaded"),
    ]
    decisions = spark.createDataFrame([(ids[j], s, a, "me") for j, s, a in log], "attempt_id string, seq int, action string, actor string")
    names = {v: k for k, v in ids.items()}
    got = sorted((names[r["attempt_id"]], r["seq"], r["error_code"], r["status"]) for r in K.conflict_resolve(summaries, decisions).na.fill("").collect())
    assert got == [
        ("diff", 1, "InvalidAction", ""), ("diff", 2, "", "kept_existing"), ("diff", 3, "", "kept_existing"),
        ("diff", 4, "ConflictAlreadyResolved", ""), ("diff", 5, "ConflictAlreadyResolved", ""),
        ("exact", 1, "CannotResolveAutoDeduped", ""), ("new", 1, "ConflictSummaryNotFound", ""), ("uid", 1, "", "promoted_uploaded"),
    ]


OBS = "observation_id string, sop_instance_uid string, observed_at date"


def day(n):
    return dt.date(2024, 1, n)


def test_promotion_clears_the_old_flag(spark):
    obs = spark.createDataFrame([("a", "i1", day(1)), ("b", "i1", day(2)), ("c", "i1", day(3)), ("d", "i2", day(1))], OBS)
    pointers = K.promote_uploaded(C.canonical_pointers(obs), obs.where("observation_id IN ('b', 'c')"))
    assert rows(pointers) == [("i1", "c", "a"), ("i2", "d", None)]
    assert rows(K.canonical_flags(obs, pointers), "observation_id", "is_canonical") == [("a", False), ("b", False), ("c", True), ("d", True)]


def test_canonical_never_moves_on_later_or_earlier_arrivals(spark):
    held = spark.createDataFrame([("i1", "b"), ("i3", "z")], "sop_instance_uid string, canonical_observation_id string")
    obs = spark.createDataFrame([("a", "i1", day(1)), ("b", "i1", day(2)), ("c", "i2", day(1))], OBS)
    assert rows(C.canonical_pointers(obs, held)) == [("i1", "b", 2), ("i2", "c", 1), ("i3", "z", 0)]
    assert rows(C.canonical_select(obs, held), "observation_id", "is_canonical") == [("a", False), ("b", True), ("c", True)]


def test_upsert_keeps_first_attributes(spark):
    columns = "k string, v string, observed_at date, observation_id string"
    stored = spark.createDataFrame([("x", "old", day(5), "o")], columns)
    batch = spark.createDataFrame([("x", "new", day(1), "p"), ("y", "late", day(3), "q"), ("y", "first", day(2), "r"), (None, "n", day(1), "s")], columns)
    assert rows(C.first_wins_upsert(batch, stored, "k", ["v"])) == [("x", "old"), ("y", "first")]


def test_findings_upsert_repeats_nothing(spark):
    obs = spark.createDataFrame([("a", "i1", day(1)), ("b", "i1", day(2)), ("c", "i1", day(2))], OBS)
    found = D.identity_duplicates(obs)
    assert D.findings_upsert(found, found.unionByName(found)).count() == found.count() == 2
    resolved = D.findings_resolve(found, found.where("observation_id = 'b'"))
    assert rows(resolved, "observation_id", "resolution_status") == [("b", "resolved"), ("c", "open")]


def test_archive_rules_in_order(spark):
    big, mb = 60 * 1024 * 1024, 1024 * 1024
    entries = [
        ("ok", 1, "a/../b", 10, 5, 0), ("ok", 2, "dir/", 0, 0, 0), ("ok", 3, "z", mb, 1, 0),
        ("path", 1, "x", 10, 5, 0), ("path", 2, "a/../../b", 10, 5, 0), ("path", 3, "y", big, big, 0),
        ("size", 1, "y", big, big, 0), ("size", 2, "../b", 10, 5, 0),
        ("ratio", 1, "y", 2 * mb, 1024, 0), ("total", 1, "y", big, big, 0), ("total", 2, "../y", big, big, 0),
        ("deep", 1, "../y", big, big, 4), ("dots", 1, "a..b", 1, 1, 3), ("back", 1, "a\\../b", 1, 1, 0),
    ]
    df = spark.createDataFrame(entries, "archive_id string, entry_no int, name string, file_size long, compress_size long, depth int")
    assert rows(archive_safety(df), "archive_id", "error_code", "rule") == [
        ("back", V.ARCHIVE_PATH, "path"), ("deep", V.ARCHIVE_DEPTH, "depth"), ("dots", V.ARCHIVE_PATH, "path"), ("ok", None, None),
        ("path", V.ARCHIVE_PATH, "path"), ("ratio", V.ARCHIVE_BOMB, "ratio"), ("size", V.ARCHIVE_BOMB, "entry_size"),
        ("total", V.ARCHIVE_BOMB, "total_size"),
    ]
    crowded = spark.range(11).select(F.lit("c").alias("archive_id"), F.col("id").alias("entry_no"), F.lit("x").alias("name"),
                                     F.lit(1).alias("file_size"), F.lit(1).alias("compress_size"), F.lit(0).alias("depth"))
    assert archive_safety(crowded, {**V.ARCHIVE_LIMITS, "max_entry_count": 10}).select("rule").collect()[0][0] == "entry_count"


def test_schema_compatibility(spark):
    pairs = [
        ("1.0", "2.0", ["a"], [], ["a"]), ("1.0", "1.1", ["a"], [], ["a", "c", "b"]), ("1.0", "1.1", ["a"], ["b"], ["a", "b"]),
        ("1.0", "1.1", ["a"], [], ["a"]), ("1.0.0", "1.0.1", ["a"], [], ["a", "b"]), ("1", "1.0.0", ["a"], [], ["a"]),
        ("1.2", "1.1", ["a"], [], ["a", "b"]), ("1.9", "1.10", ["a"], [], ["a", "b"]),
    ]
    df = spark.createDataFrame(pairs, "old_version string, new_version string, old_required array<string>, old_optional array<string>, new_required array<string>")
    assert [tuple(r) for r in E.schema_compat(df).select("level", "reason").collect()] == [
        ("incompatible", "Major version changed: 1.0 -> 2.0"), ("requires_reparse", "New required fields added: b, c"),
        ("requires_reparse", "New required fields added: b"), ("compatible", "Minor version with only optional additions"),
        ("compatible", "Patch version change only"), ("compatible", "Same version"), ("compatible", "Same version"),
        ("requires_reparse", "New required fields added: b"),
    ]


def test_binding_log(spark):
    bindings = spark.createDataFrame(
        [("b1", "o1", "i1", day(1)), ("b2", "o2", "i2", day(1)), ("b3", "o3", "i3", day(1)), ("b4", "o4", "i1", day(2))],
        "binding_id string, observation_id string, sop_instance_uid string, observed_at date",
    ).withColumns({"binding_status": F.lit("pending"), "retry_count": F.lit(0)})
    log = spark.createDataFrame(
        [("b1", 1, False, "E1", "d1"), ("b1", 2, True, None, None), ("b1", 3, False, "E9", "late")]
        + [("b2", n, False, f"E{n}", None) for n in range(1, 6)],
        "binding_id string, seq int, success boolean, error_code string, error_detail string",
    )
    state = B.binding_apply(bindings, log)
    assert rows(state, "binding_id", "binding_status", "retry_count", "error_code", "error_detail") == [
        ("b1", "bound", 1, "", ""), ("b2", "failed", 5, "E5", "Unknown binding failure"), ("b3", "pending", 0, "", ""), ("b4", "pending", 0, "", ""),
    ]
    assert rows(B.binding_retryable(state), "binding_id") == [("b3",), ("b4",)]
    assert rows(B.binding_latest(state), "sop_instance_uid", "binding_id") == [("i1", "b4"), ("i2", "b2"), ("i3", "b3")]


def test_outcome_may_not_change(spark):
    log = spark.createDataFrame(
        [("x", "accepted", 1, 1), ("x", "failed", 2, 2), ("x", "failed", 3, 3), ("x", "accepted", 4, 4), ("y", None, 1, 5), ("y", "rejected", 2, 6)],
        "item_id string, outcome string, ts int, event_id int",
    )
    assert rows(L.outcome_conflicts(log)) == [("x", "accepted", "failed", 2)]


def test_job_transitions(spark):
    states = ["receiving", "receiving", "scanning", "processing", "finalizing", "completed", "reindexing", "completed", "failed", "scanning"]
    log = spark.createDataFrame(
        [("j", dt.datetime(2024, 1, 1, n), n, s) for n, s in enumerate(states)] + [("k", dt.datetime(2024, 1, 1), 99, "completed")],
        "job_id string, ts timestamp_ntz, event_id int, state string",
    )
    assert rows(L.transition_check(log)) == [("j", 9, "failed", "scanning"), ("k", 99, "created", "completed")]


def test_requests_without_key_are_all_accepted(spark):
    columns = "request_id int, actor_id string, idempotency_key string, body string, requested_at int"
    requests = spark.createDataFrame(
        [(1, "a", "k", "x", 1), (2, "a", "k", "x", 2), (3, "a", "k", "y", 3), (4, "b", "k", "y", 4), (5, "a", None, "x", 5), (6, "a", None, "x", 6)], columns
    )
    got = rows(L.job_idempotency(requests), "request_id", "job_request_id", "verdict")
    assert got == [(1, 1, "accepted"), (2, 1, "replayed"), (3, 1, "conflict"), (4, 4, "accepted"), (5, 5, "accepted"), (6, 6, "accepted")]


def test_forced_replay_attempts_every_stage(spark):
    item = spark.range(1).select(
        F.col("id").alias("item_id"), F.lit("accepted").alias("outcome"), F.lit("s3://x").alias("storage_uri"),
        F.lit(None).cast("string").alias("last_retryable_stage"), *[F.lit("completed").alias(a) for a in V.AXES],
    )
    assert replay.replay_plan(item).count() == 0
    forced = replay.replay_plan(item, "binding", force=True)
    assert rows(forced, "stage_no", "stage", "attempted") == [(6, "binding", True), (7, "indexing", True)]
    assert rows(replay.retry_summary(item.select(F.lit("j").alias("job_id"), F.lit(False).alias("success"), F.lit("E").alias("error_code")), dry_run=True)) == [
        ("j", 1, 0, 0, 0, True, True)
    ]


def test_quantiles_of_open_and_first_bucket(spark):
    df = spark.createDataFrame([("low", 1.0), ("low", 2.0), ("high", 99999.0), ("mid", 20.0), ("mid", 30.0)], "k string, v double")
    got = dict(rows(M.histogram_quantile(df, ["k"], "v", V.STAGE_BUCKETS_MS, 0.5), "k", "estimate"))
    assert got == {"high": 10000.0, "low": 5.0, "mid": 30.0}


def test_projection_scope_and_reindex(spark, tmp_path):
    inst = spark.createDataFrame(
        [("i1", "s1", "t1", "o1", day(1)), ("i2", "s1", "t1", "o2", day(5)), ("i3", "s2", "t2", None, day(5))],
        "sop_instance_uid string, series_instance_uid string, study_instance_uid string, canonical_observation_id string, observed_at date",
    )
    empty = {c: F.lit(None).cast("string") for c in P.PROJECTION}
    fresh = inst.where("canonical_observation_id IS NOT NULL").withColumns(
        {**{c: v for c, v in empty.items() if c not in inst.columns}, "instance_id": F.md5("sop_instance_uid"),
         "projection_version": F.lit("1.0.0"), "projection_source_checksum": F.lit("c")}
    ).select(P.PROJECTION)
    stored = fresh.where("sop_instance_uid = 'i1'").withColumn("projection_version", F.lit("0.1"))
    assert rows(P.rebuild_select(inst, stored)) == [("i1",), ("i2",)]
    assert rows(P.rebuild_select(inst, stored, P.Scope(from_date="2024-01-02", to_date="2024-01-09"))) == [("i2",)]
    assert rows(P.rebuild_select(inst, stored, P.Scope(study_uid="t2"))) == []
    assert P.reindex_run(inst, fresh, stored, str(tmp_path / "dry"), dry_run=True).count() == 1
    assert not (tmp_path / "dry").exists()
    path = str(tmp_path / "model")
    for _ in range(2):  # running it again gives the same read model
        steps = P.reindex_run(inst, fresh, stored, path)
        assert rows(steps, "step_no", "status", "n") == [(1, "success", 2), (2, "success", 2), (3, "success", 0)]
        assert spark.read.parquet(path).count() == 2


def test_invariants_find_nothing_in_a_sound_ledger(spark):
    obs = spark.createDataFrame([("a", "i1", day(1)), ("b", "i1", day(2))], OBS)
    flagged = C.canonical_select(obs).withColumns({"series_instance_uid": F.lit("s"), "study_instance_uid": F.lit("t")})
    violations = C.ledger_invariants(
        instances=flagged.select("sop_instance_uid").distinct(),
        series=flagged.select("series_instance_uid", "study_instance_uid").distinct(),
        studies=flagged.select("study_instance_uid").distinct(),
        observations=flagged,
        findings=D.identity_duplicates(obs),
        items=spark.createDataFrame([("x", "at", "j"), ("y", None, "j")], "item_id string, attempt_id string, job_id string"),
        attempts=spark.createDataFrame([("at", "j")], "attempt_id string, job_id string"),
    )
    assert violations.count() == 0
