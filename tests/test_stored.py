"""Stored tables: pruned pages, merges that rewrite what they touch, commits, resumed rebuilds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsledger.operators import projection as P
from obsledger.operators import stored as S
from obsledger.operators.duplicates import FINDING, findings_upsert
from obsledger.operators.references import EDGE, edges_upsert
from obsledger.sources.buckets import BucketTable
from tests.conftest import rows


def model(spark, n, **changed):
    """Read model rows of `n` instances over twenty years."""
    number = F.col("id").cast("string")
    cols = {c: F.lit(None).cast("string") for c in P.PROJECTION}
    cols |= {
        "sop_instance_uid": F.concat(F.lit("1.2."), number), "instance_id": F.md5(F.concat(F.lit("1.2."), number)), "study_instance_uid": number,
        "modality": F.when(F.col("id") % 2 == 0, "MR").otherwise("CT"), "study_date": F.when(F.col("id") % 50 != 0, F.make_date(1990 + F.col("id") % 20, F.lit(3), F.lit(4))),
        "binding_status": F.lit("pending"), "projection_version": F.lit("1.0.0"), "projection_source_checksum": F.md5(number),
    }
    cols |= {c: F.lit(v) for c, v in changed.items()}
    return spark.range(n).select(*[v.alias(c) for c, v in cols.items()])


def test_pages_prune_and_push(spark, tmp_path, capsys):
    table = S.open_table(spark, str(tmp_path), "projections", 32).create(S.with_year(model(spark, 4000)))
    filters = {"modality": "MR", "study_date_from": "1994-01-01", "study_date_to": "1995-12-31"}
    want = rows(P.projection_query(model(spark, 4000), **filters), "instance_id")
    got, after = [], None
    while True:
        page = S.stored_page(table, 37, after, **filters)
        part = [r["instance_id"] for r in page.collect()]
        if not part:
            break
        page.explain("formatted")
        plan = capsys.readouterr().out
        assert "PartitionFilters: [" in plan and "study_year" in plan.split("PartitionFilters:")[1].splitlines()[0]
        pushed = plan.split("PushedFilters:")[1].splitlines()[0]
        assert "EqualTo(modality,MR)" in pushed and "study_date" in pushed
        got, after = got + part, part[-1]
    assert [(g,) for g in got] == want
    every = table.read().select("_metadata.file_path").distinct().count()
    first = S.stored_rows(table, [0], **filters).select("_metadata.file_path").distinct().count()
    assert every >= 600 and 0 < first <= every / 100  # 32 buckets of 20 years and no year


@pytest.mark.parametrize(("after", "per_page"), [(None, 1), (None, 10_000), ("ffff", 5), ("0", 3), ("8", 500)])
def test_any_cursor_and_size(spark, tmp_path, after, per_page):
    table = S.open_table(spark, str(tmp_path), "projections", 8).create(S.with_year(model(spark, 300)))
    page = S.stored_page(table, per_page, after)
    want = P.projection_query(model(spark, 300), per_page=per_page, after=after or "")
    assert [r["instance_id"] for r in page.collect()] == [r["instance_id"] for r in want.collect()]


def contents(table):
    return rows(table.read())


def test_merge_rewrites_what_it_touches(spark, tmp_path):
    table = S.open_table(spark, str(tmp_path), "projections", 16).create(S.with_year(model(spark, 500)))
    folders = {b: c[1] for b, c in table.live().items()}
    batch = model(spark, 500).where("study_instance_uid IN ('3', '4')")
    batch = batch.withColumn("projection_source_checksum", F.lit("new")).unionByName(model(spark, 20))  # two changes, twenty rows as they are
    want = rows(P.projection_merge(batch.where("projection_source_checksum = 'new'"), model(spark, 500)))
    touched = S.merge_projections(table, batch.where("study_instance_uid NOT IN ('3', '4') OR projection_source_checksum = 'new'"))
    assert touched == table.touched(batch.where("projection_source_checksum = 'new'")) and len(touched) <= 2
    assert {b for b, c in table.live().items() if c[1] != folders[b]} == set(touched)
    assert rows(table.read().select(P.PROJECTION)) == want
    before = table.live()
    assert S.merge_projections(table, batch.where("projection_source_checksum = 'new'")) == [] and table.live() == before


def test_a_run_that_is_killed_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = S.open_table(spark, str(tmp_path), "projections", 4).create(S.with_year(model(spark, 100)))
    before, batch = contents(table), model(spark, 130, modality="US", projection_version="0.9")

    def killed(self, rows):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(BucketTable, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            S.merge_projections(table, batch)
    assert contents(table) == before
    assert S.merge_projections(table, batch) == [0, 1, 2, 3]
    assert rows(table.read().select(P.PROJECTION)) == rows(P.projection_merge(batch, model(spark, 100)))


def findings(spark, ids, status):
    day = dt.date(2024, 1, 1)
    made = [(f"{i:032x}"[::-1], f"o{i}", "identity", "uid", None, None, status, day) for i in ids]
    return spark.createDataFrame(made, "finding_id string, observation_id string, duplicate_type string, basis string, matched_observation_id string, matched_instance_uid string, resolution_status string, observed_at date")


def test_findings_and_edges(spark, tmp_path):
    table = S.open_table(spark, f"{tmp_path}/f", "findings", 16).create(findings(spark, range(20), "accepted"))
    new = findings(spark, [3, 4, 30, 30], "open")
    assert S.merge_findings(table, new) == table.touched(findings(spark, [30], "open"))
    assert rows(table.read(), *FINDING) == rows(findings_upsert(findings(spark, range(20), "accepted"), new), *FINDING)
    assert S.merge_findings(table, new) == []

    kind = "from_sop string, relationship string, to_study string, to_series string, to_sop string, frame_number int, status string, resolved_sop string"
    old = spark.createDataFrame([(f"a{i}", "r", None, None, f"b{i}", None, "unresolved", None) for i in range(30)], kind)
    new = spark.createDataFrame([("a1", "r", None, None, "b1", None, "resolved", "b1"), ("a2", "r", None, None, "b2", None, "unresolved", None), ("z", "r", None, None, "b", 1, "unresolved", None)], kind)
    table = S.open_table(spark, f"{tmp_path}/e", "edges", 64).create(S.edges_with_key(old))
    touched = S.merge_edges(table, new)
    assert 0 < len(touched) <= 2 and rows(table.read(), *EDGE, "status", "resolved_sop") == rows(edges_upsert(old, new), *EDGE, "status", "resolved_sop")
    assert S.merge_edges(table, new) == []


def test_odd_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing was committed"):
        S.open_table(spark, f"{tmp_path}/none", "projections").read()
    empty = S.open_table(spark, f"{tmp_path}/empty", "projections", 4).create(S.with_year(model(spark, 0)))
    assert empty.read().count() == 0 and S.stored_page(empty, 5).count() == 0 and empty.read().columns == [*P.PROJECTION, S.YEAR]
    assert S.merge_projections(empty, model(spark, 3)) != [] and empty.read().count() == 3
    with pytest.raises(ValueError, match="outside the buckets"):
        empty.replace(S.with_year(model(spark, 50)), [0])
    assert empty.read().count() == 3


def test_a_rebuild_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    stored, fresh = model(spark, 200, projection_version="0.9"), model(spark, 200)
    table = S.open_table(spark, str(tmp_path), "projections", 16).create(S.with_year(stored))
    instances = fresh.select("sop_instance_uid", "study_instance_uid", "series_instance_uid", F.lit(dt.date(2024, 1, 1)).alias("observed_at"), F.lit("o").alias("canonical_observation_id"))
    made, replace = [], BucketTable.replace

    def fails_later(self, rows, buckets, job=None):
        if self.path == table.path and len(made) == 2:
            raise KeyboardInterrupt
        made.append(list(buckets)) if self.path == table.path else None
        return replace(self, rows, buckets, job)

    with monkeypatch.context() as patched:
        patched.setattr(BucketTable, "replace", fails_later)
        with pytest.raises(KeyboardInterrupt):
            S.rebuild_stored(table, "job1", instances, fresh, buckets_at_once=3)
    assert len({r["projection_version"] for r in table.read().collect()}) == 2
    steps = S.rebuild_stored(table, "job1", instances, fresh.where("false"), buckets_at_once=3).collect()  # the staged rows are taken
    assert [(r["step"], r["status"], r["n"]) for r in steps] == [("analyze", "success", 200), ("rebuild_projections", "success", 200), ("verify", "success", 0)]
    done = [r["bucket"] for r in table.commits().where("job = 'job1'").collect()]
    assert sorted(done) == list(range(16))  # no bucket twice
    assert rows(table.read().select(P.PROJECTION)) == rows(fresh)


def test_a_rebuild_of_one_study_touches_its_buckets(spark, tmp_path):
    table = S.open_table(spark, str(tmp_path), "projections", 32).create(S.with_year(model(spark, 200, projection_version="0.9")))
    fresh = model(spark, 200)
    instances = fresh.select("sop_instance_uid", "study_instance_uid", "series_instance_uid", F.lit(None).cast("date").alias("observed_at"), F.lit("o").alias("canonical_observation_id"))
    S.rebuild_stored(table, "one", instances, fresh, P.Scope(study_uid="5"))
    assert table.commits().where("job = 'one'").count() == 1
    assert rows(table.read().where("projection_version = '1.0.0'"), "study_instance_uid") == [("5",)]
