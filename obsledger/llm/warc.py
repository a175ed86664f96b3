"""Revisit records that say "not modified": found their response by an as-of join, headers merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.sharding import range_of
from obsledger.llm.url_filters import canonical_form

ROWS_PER_SLICE = 1_000_000
SAMPLES_PER_SLICE = 64
# Header fields that a 304 may carry and that replace the stored ones: fixed values.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
CAPTURE = "record_id bigint, url string, at bigint, kind string, status int, digest string, headers map<string,string>"


def _slices(captures: DataFrame, rows_per_slice: int) -> Column:
    """Slice of time of each row: about equal numbers of rows, whatever the times, cut between (at, record_id)."""
    n = captures.count()
    slices = -(-n // rows_per_slice)
    if slices < 2:
        return F.lit(0)
    chance = F.pmod(F.xxhash64("at", "record_id", F.lit(1)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = captures.where(chance * n < SAMPLES_PER_SLICE * slices).select("at", "record_id").collect()
    sample = sorted((r["at"], r["record_id"]) for r in sample if r["at"] is not None and r["record_id"] is not None)
    cuts = sorted({sample[len(sample) * i // slices] for i in range(1, slices)}) if sample else []
    if not cuts:
        return F.lit(0)
    array = F.from_json(F.lit("[" + ",".join(f'{{"at":{a},"record_id":{b}}}' for a, b in cuts) + "]"), "array<struct<at:bigint,record_id:bigint>>")
    return range_of(array, len(cuts), F.struct("at", "record_id"))


def _header(headers: Column, name: str) -> Column:
    return F.nullif(F.trim(F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name)), F.lit(0))), F.lit(""))


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of a name given twice in different case, the first counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(entries, lambda e, i: F.array_position(names, F.lower(e["key"])) == i + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def merged_headers(stored: Column, fresh: Column, permitted: Sequence[str] = PERMITTED) -> Column:
    """The stored response's fields, those that `fresh` may replace replaced; names in lower case."""
    fresh = F.map_filter(_lowered(fresh), lambda k, _: k.isin(*permitted))
    kept = F.map_filter(_lowered(stored), lambda k, _: ~F.map_contains_key(fresh, k))
    return F.map_concat(kept, fresh)


def resolve_revisits(captures: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Every revisit of `captures` with the latest earlier full response of its canonical address.

    captures: `CAPTURE` columns, others are ignored; kind is response or revisit. Full: a response
    of status 200. Earlier: by (at, record_id). The validators decide the `state`: entity tags, by
    weak comparison, where both have one; else dates of last change; else payload digests.
    States: resolved, validator_mismatch, no_validator (nothing to compare), no_response. Only a
    resolved revisit has `headers`, the stored ones with the permitted ones of the revisit.

    Columns: record_id, url_key, revisit_at, response_id, response_at, digest, state, headers. A revisit
    with a null url, time or id finds no response; repeated revisits are resolved each, and of
    equal responses either will do. No rows give no rows.

    Rows of one address are cut into slices of time of about `rows_per_slice` rows of the whole
    table; a window runs inside (address, slice), and each slice takes over the last response of
    the slices before it. So an address that holds a third of all rows is no single task's.
    """
    rows = captures.select(
        F.col("record_id").cast("bigint").alias("record_id"),
        F.when(F.col("url").isNotNull(), canonical_form(F.col("url"))).alias("url_key"),
        F.col("at").cast("bigint").alias("at"),
        ((F.col("kind") == "response") & (F.col("status") == 200)).alias("full"),
        (F.col("kind") == "revisit").alias("revisit"),
        F.struct("record_id", "at", "digest", "headers").alias("own"),
    ).where("full OR revisit")
    known = F.col("url_key").isNotNull() & F.col("at").isNotNull() & F.col("record_id").isNotNull()
    lost = rows.where(~known & F.col("revisit")).withColumn("found", F.lit(None).cast(rows.schema["own"].dataType))
    rows = rows.where(known)
    rows = rows.withColumn("slice", _slices(rows, rows_per_slice))
    response = F.when(F.col("full"), F.col("own"))
    order = Window.partitionBy("url_key", "slice").orderBy("at", "record_id")
    inside = F.last(response, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = rows.where("full").groupBy("url_key", "slice").agg(F.max_by("own", F.struct("at", "record_id")).alias("end"))
    taken = rows.where("revisit").select("url_key", "slice").distinct().join(ends, ["url_key", "slice"], "full")
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = taken.select("url_key", "slice", F.last("end", ignorenulls=True).over(before).alias("carried"))
    found = rows.withColumn("inside", inside).where("revisit").join(carried, ["url_key", "slice"], "left")
    found = found.withColumn("found", F.coalesce("inside", "carried")).select(*lost.columns).unionByName(lost)

    def pair(name: str) -> tuple[Column, Column]:
        return _header(F.col("own.headers"), name), _header(F.col("found.headers"), name)

    def tag(c: Column) -> Column:
        return F.regexp_replace(c, "^W/", "")

    (etag, stored_etag), (changed, stored_changed) = pair("etag"), pair("last-modified")
    same = F.coalesce(tag(etag) == tag(stored_etag), changed == stored_changed, F.col("own.digest") == F.col("found.digest"))
    state = (
        F.when(F.col("found").isNull(), "no_response")
        .when(same.isNull(), "no_validator")
        .when(same, "resolved")
        .otherwise("validator_mismatch")
    )
    return found.withColumn("state", state).select(
        "record_id",
        "url_key",
        F.col("at").alias("revisit_at"),
        F.col("found.record_id").cast("bigint").alias("response_id"),
        F.col("found.at").cast("bigint").alias("response_at"),
        F.when(F.col("state") == "resolved", F.col("found.digest")).alias("digest"),
        "state",
        F.when(F.col("state") == "resolved", merged_headers(F.col("found.headers"), F.col("own.headers"))).alias("headers"),
    )
