"""Safety rules over archive listings; archives themselves are not unpacked here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.rules import normalized_path


def unsafe_entry_path(name: Column) -> Column:
    """The name leads out of the archive or keeps a suspicious `..`."""
    escapes = normalized_path(name).startswith("..") | normalized_path(name).contains("\\../")
    rest = F.replace(F.replace(name, F.lit("../"), F.lit("")), F.lit("..\\"), F.lit(""))
    return escapes | rest.contains("..")


def archive_safety(entries: DataFrame, limits: dict[str, int] = V.ARCHIVE_LIMITS) -> DataFrame:
    """Verdict per archive: the first rule it breaks, null when none.

    `entries`: archive_id, entry_no, name, file_size, compress_size, depth. Depth, entry
    count and total size come first, then the entries in order: path, size, ratio. All
    of it is one aggregate; the first bad entry is a minimum, so no archive is gathered.
    """
    ratio = F.col("file_size") / F.col("compress_size")
    rule = (
        F.when(unsafe_entry_path(F.col("name")), F.struct(F.lit(V.ARCHIVE_PATH).alias("code"), F.lit("path").alias("rule")))
        .when(F.col("file_size") > limits["max_entry_bytes"], F.struct(F.lit(V.ARCHIVE_BOMB).alias("code"), F.lit("entry_size").alias("rule")))
        .when(
            (F.col("compress_size") > 0) & (F.col("file_size") > V.ARCHIVE_RATIO_FLOOR)
            & (F.when(F.col("compress_size") > 0, ratio) > V.ARCHIVE_RATIO),
            F.struct(F.lit(V.ARCHIVE_BOMB).alias("code"), F.lit("ratio").alias("rule")),
        )
    )
    judged = entries.withColumn("_rule", rule)
    summed = judged.groupBy("archive_id").agg(
        F.max("depth").alias("_depth"),
        F.count(F.lit(1)).alias("entry_count"),
        F.sum("file_size").alias("total_size"),
        F.min_by("_rule", F.when(F.col("_rule").isNotNull(), F.col("entry_no"))).alias("_first"),
    )
    broken = {
        "depth": (F.col("_depth") > limits["max_nesting_depth"], V.ARCHIVE_DEPTH),
        "entry_count": (F.col("entry_count") > limits["max_entry_count"], V.ARCHIVE_BOMB),
        "total_size": (F.col("total_size") > limits["max_total_bytes"], V.ARCHIVE_BOMB),
    }
    code = F.coalesce(*[F.when(cond, F.lit(error)) for cond, error in broken.values()], F.col("_first.code"))
    named = F.coalesce(*[F.when(cond, F.lit(name)) for name, (cond, _) in broken.items()], F.col("_first.rule"))
    return summed.select("archive_id", "entry_count", "total_size", code.alias("error_code"), named.alias("rule"))
