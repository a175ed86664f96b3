"""The stored side: what to put into the content store, and writing ledger tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.skew import lookup_join


def content_store_plan(blobs: DataFrame, store: DataFrame) -> DataFrame:
    """What to do with each received blob: store, skip, or refuse for a wrong hash.

    `blobs`: item_id, content, declared_sha256; `store`: sha256 of what is held. Of equal
    blobs the first is stored. A common blob is counted once per input partition.
    """
    hashed = blobs.select(
        "item_id", F.sha2("content", 256).alias("sha256"), "declared_sha256", F.octet_length("content").alias("byte_size")
    )
    wrong = F.col("declared_sha256").isNotNull() & (F.lower("declared_sha256") != F.col("sha256"))
    sound = hashed.where(~wrong)
    first = (
        sound.groupBy("sha256")
        .agg(F.min("item_id").alias("_first"))
        .join(store.select("sha256", F.lit(True).alias("_held")).distinct(), "sha256", "left")
    )
    planned = lookup_join(sound, first, ["sha256"], ["item_id"], "left").select(
        *hashed.columns,
        F.when(F.col("_held"), "already_stored").when(F.col("item_id") == F.col("_first"), "store")
        .otherwise("already_stored").alias("action"),
    )
    return planned.unionByName(hashed.where(wrong).select("*", F.lit("hash_mismatch").alias("action")))


def write_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that `df` has rows for; running it again changes nothing.

    The rebalance hint brings a partition's rows together and still splits one that is
    too large for a single task.
    """
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
