"""File sources: inventories, explicit lists, magic bytes, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.rules import looks_like_image, normalized_path


def list_files(inventory: DataFrame, root: str, recursive: bool = True) -> DataFrame:
    """Files below `root` of an inventory table (path, byte_size, modified_at), hidden ones too.

    Without `recursive` only those that lie in `root` itself. Contents are never read.
    """
    prefix = root.rstrip("/") + "/"
    below = inventory.where(F.col("path").startswith(prefix)).withColumn("relative_path", F.substr("path", F.lit(len(prefix) + 1)))
    if not recursive:
        below = below.where(~F.col("relative_path").contains("/"))
    return below.select("path", "relative_path", "byte_size", "modified_at")


def _parts(path: Column) -> Column:
    """A path as it sorts: part by part."""
    return F.split(path, "/")


def scan_files(listing: DataFrame, max_items: int | None = None, max_file_bytes: int | None = None) -> DataFrame:
    """Items and errors of a listing, in path order, part by part.

    Files over `max_file_bytes` are errors. After `max_items` items the scan ends: one
    `MaxItemsExceeded` error if files remain, and no rows for anything behind. That limit is
    the source's stop rule; it is off by default, and meant for small numbers.
    """
    columns = ["relative_path", "byte_size"]
    listing = listing.select(*columns, _parts(F.col("relative_path")).alias("_parts"))
    too_large = F.lit(False) if max_file_bytes is None else F.col("byte_size") > max_file_bytes
    items = listing.where(~too_large)
    large = listing.where(too_large)
    nothing = F.lit(None).cast("string")
    end = None
    if max_items is not None:
        items = items.orderBy("_parts").limit(max_items)
        full = items.agg(F.when(F.count(F.lit(1)) >= max_items, F.coalesce(F.max("_parts"), F.array(F.lit("")))).alias("end"))
        end = full.scalar()
        large = large.where(end.isNull() | (F.col("_parts") < end))
    result = items.select(*columns, nothing.alias("error_code"), nothing.alias("error_detail")).unionByName(
        large.select(*columns, F.lit(V.FILE_TOO_LARGE).alias("error_code"), F.col("byte_size").cast("string").alias("error_detail"))
    )
    if end is not None:
        left = listing.where(F.col("_parts") > end).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        result = result.unionByName(
            left.select(
                F.lit("").alias("relative_path"), F.lit(None).cast("bigint").alias("byte_size"),
                F.lit(V.MAX_ITEMS).alias("error_code"), F.lit(str(max_items)).alias("error_detail"),
            )
        )
    return result


def _below(path: Column, root: str) -> Column:
    clean = root.rstrip("/")
    return (path == clean) | path.startswith(clean + "/")


def scan_file_list(entries: DataFrame, listing: DataFrame, allowed_roots: Sequence[str]) -> DataFrame:
    """Listed paths as items, or errors when outside the roots or not there.

    `entries`: path; `listing`: path, byte_size of the files that exist.
    """
    wanted = entries.select(normalized_path(F.col("path")).alias("path"))
    root = F.coalesce(*[F.when(_below(F.col("path"), r), F.lit(r.rstrip("/"))) for r in allowed_roots])
    known = listing.select("path", F.col("byte_size").alias("_size"))
    joined = wanted.withColumn("_root", root).join(known, "path", "left")
    code = F.when(F.col("_root").isNull(), V.OUTSIDE_ROOT).when(F.col("_size").isNull(), V.FILE_NOT_FOUND)
    return joined.select(
        "path",
        F.when(code.isNull(), F.substr("path", F.length("_root") + 2)).alias("relative_path"),
        F.when(code.isNull(), F.col("_size")).alias("byte_size"),
        code.alias("error_code"),
        F.when(code == V.OUTSIDE_ROOT, "outside allowed roots").when(code == V.FILE_NOT_FOUND, "not a file").alias("error_detail"),
    )


def magic_sniff(files: DataFrame, content: str = "content", magic: bytes = V.MAGIC, offset: int = V.MAGIC_OFFSET) -> DataFrame:
    """Flag rows whose bytes look like an image."""
    return files.withColumn("is_candidate", looks_like_image(F.col(content), magic, offset))


def scan_totals(items: DataFrame) -> DataFrame:
    """Counts and bytes per job by scan verdict (`candidate`, `other`, `rejected`)."""
    return items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.coalesce(F.sum("byte_size"), F.lit(0)).alias("total_bytes"),
        *[F.count_if(F.col("verdict") == v).alias(f"{v}_items") for v in ("candidate", "other", "rejected")],
    )
