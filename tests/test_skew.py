"""The skew helpers give the plain result, with and without busy keys, hours and null keys."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsledger.functions.skew import arrival_rank, lookup_join, previous_row
from obsledger.operators import canonical as C
from obsledger.operators import duplicates as D
from obsledger.operators import references as R
from tests.conftest import rows


@pytest.fixture(scope="module")
def events(spark):
    """300 rows of which key `a` has two thirds, some keys null."""
    n = F.col("id")
    return spark.range(300).select(
        n.alias("event_id"),
        F.when(n % 3 != 0, "a").when(n % 30 == 0, None).otherwise(F.concat(F.lit("k"), (n % 11).cast("string"))).alias("key"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n * 7 % 40).cast("int")).alias("day"),
        F.concat(F.lit("v"), (n * 13 % 17).cast("string")).alias("value"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([("a", 1, "first"), ("k3", 2, None), ("k9", 3, "x"), ("unused", 4, "y")], "key string, n int, note string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(events, dimension, how):
    got = lookup_join(events, dimension, ["key"], ["event_id"], how)
    assert rows(got, *events.columns, "n", "note") == rows(events.join(dimension, "key", how), *events.columns, "n", "note")


def test_lookup_join_with_counts(events):
    counts = events.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"))
    got = lookup_join(events, counts, ["key"], ["event_id"], "left")
    assert rows(got, *events.columns, "n", "low") == rows(events.join(counts, "key", "left"), *events.columns, "n", "low")


def test_lookup_join_on_two_columns(events, dimension):
    right = dimension.withColumn("value", F.lit("v1"))
    got = lookup_join(events, right, ["key", "value"], ["event_id"], "left")
    assert rows(got, *events.columns, "n") == rows(events.join(right, ["key", "value"], "left"), *events.columns, "n")


def test_lookup_join_rejects_other_types(events, dimension):
    with pytest.raises(ValueError):
        lookup_join(events, dimension, ["key"], ["event_id"], "right")


def test_arrival_rank_equals_row_number(events):
    data = events.where("key IS NOT NULL")
    got = arrival_rank(data, ["key"], ["day", "event_id"], F.col("day").cast("string"), "rank")
    plain = data.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("day", "event_id")).cast("bigint"))
    assert rows(got) == rows(plain)


def test_previous_row_equals_lag(events):
    data = events.where("key IS NOT NULL").withColumn("value", F.when(F.col("event_id") % 5 > 0, F.col("value")))
    got = previous_row(data, ["key"], ["day", "event_id"], "value", F.col("day").cast("string"), "before")
    plain = data.withColumn("before", F.lag("value").over(Window.partitionBy("key").orderBy("day", "event_id")))
    assert rows(got) == rows(plain)


def test_null_keys_rank_like_any_other(events):
    got = arrival_rank(events, ["key"], ["day", "event_id"], F.col("day").cast("string"), "rank")
    plain = events.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("day", "event_id")).cast("bigint"))
    assert rows(got) == rows(plain)


def test_thousands_of_busy_keys_and_one_busy_bucket(spark):
    """More keys than any list of hot ones would hold, and one key whose rows share a bucket."""
    n = F.col("id")
    data = spark.range(12_000).select(
        n.alias("event_id"), F.when(n % 3 == 0, -1).otherwise(n % 2000).alias("key"), F.when(n % 3 == 0, 0).otherwise(n % 7).alias("day")
    )
    got = arrival_rank(data, ["key"], ["day", "event_id"], F.col("day").cast("string"), "rank")
    plain = data.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("day", "event_id")).cast("bigint"))
    assert got.exceptAll(plain).count() == 0 and got.count() == 12_000
    before = previous_row(data, ["key"], ["day", "event_id"], "event_id", F.col("day").cast("string"), "before")
    plain = data.withColumn("before", F.lag("event_id").over(Window.partitionBy("key").orderBy("day", "event_id")))
    assert before.exceptAll(plain).count() == 0


@pytest.fixture(scope="module")
def copies(spark):
    """One instance with most observations, all with the same pixels."""
    n = F.col("id")
    return spark.range(200).select(
        F.md5(n.cast("string")).alias("observation_id"),
        F.when(n % 4 > 0, "1.2.3").otherwise(F.concat(F.lit("1.2."), n.cast("string"))).alias("sop_instance_uid"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 9).cast("int")).alias("observed_at"),
        F.when(n % 10 > 0, "same").alias("pixel_digest"),
    )


def test_one_canonical_per_instance(copies):
    flagged = C.canonical_select(copies)
    assert flagged.count() == 200
    assert flagged.groupBy("sop_instance_uid").agg(F.count_if("is_canonical").alias("n")).where("n <> 1").count() == 0


def test_duplicate_findings_are_linear(copies):
    assert D.identity_duplicates(copies).count() == 149
    content = D.content_duplicates(copies, "pixel_digest")
    assert content.count() == 179
    assert content.select("group_size", "matched_observation_id").distinct().count() == 1
    assert D.content_groups(copies, "pixel_digest").select("n_pairs").collect()[0][0] == 180 * 179 // 2


def test_references_resolve_in_order(spark):
    instances = spark.createDataFrame(
        [("i1", "s1", "t1"), ("i2", "s2", "t2"), ("i3", "s2", "t2"), ("i4", "s4", "t4")],
        "sop_instance_uid string, series_instance_uid string, study_instance_uid string",
    )
    edges = spark.createDataFrame(
        [
            ("a", "x", None, None, "i2", None),
            ("b", "x", None, "s1", "gone", None),
            ("c", "x", "t4", "s2", None, None),
            ("d", "x", "t4", "gone", "gone", None),
            ("e", "x", "t2", None, None, 1),
            ("f", "x", "gone", "gone", "gone", None),
            ("g", "x", None, None, None, None),
        ],
        "from_sop string, relationship string, to_study string, to_series string, to_sop string, frame_number int",
    )
    got = R.refs_resolve(edges, instances)
    assert rows(got, "from_sop", "status", "resolved_sop", "resolution_path", "candidate_count") == [
        ("a", "resolved", "i2", "sop_instance_uid", 1),
        ("b", "resolved", "i1", "series_instance_uid", 1),
        ("c", "ambiguous", None, "series_instance_uid", 2),
        ("d", "resolved", "i4", "study_instance_uid", 1),
        ("e", "ambiguous", None, "study_instance_uid", 2),
        ("f", "unresolved", None, None, 0),
        ("g", "unresolved", None, None, 0),
    ]
