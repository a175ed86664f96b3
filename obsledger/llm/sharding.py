"""Sampled splitters: order rows by key, cut the order where the bytes say, number the places."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.session import written

SAMPLES_PER_RANGE = 32
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 1_000_000
OVERFULL = 2.0
ROUNDS = 4
KEY = ("_k", "_d", "_r")


def _key() -> Column:
    return F.struct(*KEY)


def range_of(array: Column, length: int, key: Column) -> Column:
    """Number of elements of a sorted `array` at or below `key`, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in range(length.bit_length() - 1, -1, -1)])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.coalesce(F.get(array, at + step - 1) <= key, F.lit(False)), step).otherwise(0),
    )


def _range_of(splitters: list[dict]) -> Column:
    if not splitters:
        return F.lit(0)
    kind = "array<struct<_k:bigint,_d:bigint,_r:bigint>>"
    return range_of(F.from_json(F.lit(json.dumps(splitters)), kind), len(splitters), _key())


def _drawn(rows: DataFrame, total: int, pieces: int, seed: int) -> list[dict]:
    """Splitters at the quantiles of a sample drawn with chances in proportion to size.

    A row of more than `total / samples` bytes is always drawn and counts with its whole size,
    every other drawn row counts alike, so sums over the sample estimate sums of bytes. About
    `SAMPLES_PER_RANGE * pieces` rows are drawn, whatever the size of the input.
    """
    share = max(total / (SAMPLES_PER_RANGE * pieces), 1.0)
    chance = F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = rows.where(chance < F.col("size") / share).select(*KEY, F.greatest("size", F.lit(share)).alias("_w"))
    upto = F.sum("_w").over(Window.orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum("_w").over(Window.partitionBy())
    quantile = F.floor(upto * F.lit(pieces) / (whole + 1))
    firsts = sample.select(_key().alias("key"), quantile.alias("q")).groupBy("q").agg(F.min("key").alias("key"))
    return [r["key"].asDict() for r in firsts.where("q > 0").collect()]


def _in_order(splitters: list[dict]) -> list[dict]:
    unique = {tuple(s[k] for k in KEY): s for s in splitters}
    return [unique[k] for k in sorted(unique)]


def sampled_splitters(rows: DataFrame, shards: int) -> DataFrame:
    """Place rows with columns `size` (bytes) and a key (`_k`, `_d`, `_r`) into shards of near-equal bytes.

    1. Size-weighted key samples give quantile boundaries for many more ranges than shards.
    2. Ranges with more than `OVERFULL` fair shares of bytes are sampled again by themselves and
       subdivided, until none is left that can be cut (rows of one hot key differ in `_d` and `_r`).
    3. Exact sums per range and running sums inside each range give every row its place in the
       whole order; the shard is the one in which the middle of the row's bytes falls.

    The sample only decides how the work is split: shards and slots are exact, and shards differ
    by at most about the size of one row. Adds `shard` (int) and `slot` (from 0, without gaps).
    Only the boundaries, at most a few per range, pass through the driver. No rows: no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n, total = totals["n"], totals["bytes"] or 0
    ranges = max(RANGES_PER_SHARD * shards, -(-n // ROWS_PER_RANGE))
    limit = OVERFULL * max(total, 1) / ranges
    splitters = _in_order(_drawn(rows, total, ranges, 0)) if n else []
    for seed in range(1, ROUNDS):
        ranged = rows.withColumn("_range", _range_of(splitters))
        loads = ranged.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        over = loads.where((F.col("bytes") > limit) & (F.col("n") > 1)).collect()
        if not over:
            break
        for r in over:  # at most `ranges` of them, rarely any
            inside = ranged.where(F.col("_range") == r["_range"])
            splitters = splitters + _drawn(inside, r["bytes"], int(r["bytes"] / limit) + 2, seed)
        splitters = _in_order(splitters)
    ranged = rows.withColumn("_range", _range_of(splitters))
    loads = ranged.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = loads.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
    )
    inside = Window.partitionBy("_range").orderBy(*KEY)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_bytes_before") + F.sum("size").over(upto) - F.col("size") / 2
    placed = (
        ranged.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn("_place", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int"))
        .drop("_range", "_bytes_before", "_rows_before")
    )
    placed = written(placed, "shards")
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    slots = placed.join(F.broadcast(first), "shard")  # one row per shard
    return slots.withColumn("slot", (F.col("_place") - F.col("_first")).cast("bigint")).drop("_place", "_first", *KEY)


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Shard documents (doc_id, text) by the hash of the text, then doc_id, under the law of equal bytes.

    Equal texts lie next to each other; a group is cut only where a boundary of bytes falls into it.
    Size: UTF-8 bytes of the text plus 8. A null text has 8 bytes, its checksum is that of the empty
    text. A null doc_id sorts first; repeated rows keep a slot each. Extra columns are not used.
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
        F.xxhash64("text").alias("_k"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_d"),
        F.monotonically_increasing_id().alias("_r"),  # tells repeated rows apart; fixed by the write
    )
    placed = sampled_splitters(written(rows, "shard_keys"), shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
