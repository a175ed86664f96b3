"""Joins and arrival windows that hold when a few keys own a large part of the rows.

All helpers are exact and treat every key alike: there is no list of hot keys, no limit that
switches plans, and nothing is broadcast or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

SLOT = "_slot"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def group_by_slot(df: DataFrame, *keys: str) -> GroupedData:
    """Group by `keys` with their hash in front, as column `_slot`.

    UIDs and paths share long beginnings, on which sorts would compare them to the end;
    led by a 64-bit hash they are told apart at once. `lookup_join` takes `_slot` over
    from its right side, so that a grouped right side is not shuffled again.
    """
    return df.groupBy(_hash(keys).alias(SLOT), *keys)


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], scatter: Sequence[str], how: str = "left") -> DataFrame:
    """Join `left` to `right`, which has at most one row per key, on the same-named `keys`.

    Rows with a null key match nothing and would pile up in one partition: a left join
    scatters them by a hash of the `scatter` columns, an inner join leaves them out. A key
    that owns many rows of `left` is split by adaptive execution, which measures partitions
    (`spark.sql.adaptive.skewJoin`). Result columns: those of `left`, then the non-key
    ones of `right`.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    values = [c for c in right.columns if c not in keys and c != SLOT]
    if SLOT not in right.columns:
        right = right.withColumn(SLOT, _hash(keys))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    if how == "inner":
        left = left.where(~no_key)
    tagged = left.withColumn(SLOT, F.when(no_key, F.xxhash64(*scatter)).otherwise(_hash(keys)))
    return tagged.join(right.select(SLOT, *keys, *values), [SLOT, *keys], how).select(*left.columns, *values)


def _bucketed(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Rows with `_key`, in which nulls equal each other, and `_bucket`, empty text for a null one."""
    return df.withColumns({"_key": F.struct(*keys), "_bucket": F.coalesce(bucket, F.lit(""))})


def arrival_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str) -> DataFrame:
    """Add `name`: 1, 2, 3, … within `keys` by ascending `order`.

    `bucket` is text that never decreases along `order`. Rows are ranked per key and bucket
    and shifted by the sizes of the key's earlier buckets, so no task sorts more than one
    bucket of a key at once. The shift join reuses the window's partitioning.
    """
    tagged = _bucketed(df, keys, bucket)
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        tagged.groupBy("_key", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_key", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy("_key", "_bucket").orderBy(*order))
    return (
        tagged.withColumn("_local", local)
        .join(shifts, ["_key", "_bucket"])
        .select(*df.columns, (F.col("_local") + F.col("_shift")).cast("bigint").alias(name))
    )


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, name: str) -> DataFrame:
    """Add `name`: the `value` of the row just before within `keys` by `order`, null for the first.

    Same scheme as `arrival_rank`: the first row of a bucket takes the last value of the
    bucket before it.
    """
    tagged = _bucketed(df, keys, bucket)
    ends = (
        tagged.groupBy("_key", "_bucket")
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_end"))
        .select("_key", "_bucket", F.lag("_end").over(Window.partitionBy("_key").orderBy("_bucket")).alias("_carried"))
    )
    within = Window.partitionBy("_key", "_bucket").orderBy(*order)
    return (
        tagged.withColumn("_before", F.lag(F.struct(value)).over(within))
        .join(ends, ["_key", "_bucket"])
        .select(*df.columns, F.coalesce("_before", "_carried")[value].alias(name))
    )
