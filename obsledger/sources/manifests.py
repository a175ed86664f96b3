"""Curated uploads: samples below a data folder and their annotations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V


@dataclass(frozen=True)
class AnnotationSpec:
    """One entry of a manifest's annotation list; `root` is its folder."""

    root: str
    label: str
    required: bool = False
    task_type: str | None = None


def curated_samples(listing: DataFrame, data_root: str) -> DataFrame:
    """Files below `data_root` with their sample; ids used by two containers are errors.

    The sample is the first folder, or the stem of a file that lies directly below the root.
    """
    prefix = data_root.rstrip("/") + "/"
    rest = F.substr("path", F.lit(len(prefix) + 1))
    first = F.element_at(F.split("_rest", "/"), 1)
    in_folder = F.contains("_rest", F.lit("/"))
    files = (
        listing.where(F.col("path").startswith(prefix))
        .withColumn("_rest", rest)
        .select(
            "path", "byte_size",
            F.when(in_folder, first).otherwise(F.regexp_replace(first, r"(?<=.)\.[^.]+$", "")).alias("sample_id"),
            F.when(in_folder, F.concat(F.lit("dir:"), first)).otherwise(F.concat(F.lit("file:"), first)).alias("container"),
        )
    )
    repeated = (
        files.groupBy("sample_id")
        .agg((F.min("container") != F.max("container")).alias("_repeated"))
        .where("_repeated")
    )
    return files.join(repeated, "sample_id", "left").select(
        "path", "byte_size", "sample_id", "container",
        F.when(F.col("_repeated"), V.DUPLICATE_SAMPLE).alias("error_code"),
    )


def _first_level(listing: DataFrame, specs: Sequence[AnnotationSpec]) -> DataFrame:
    """What lies directly below each annotation folder, as (spec_no, entry, is_dir)."""
    roots = F.array(*[F.struct(F.lit(i).alias("spec_no"), F.lit(s.root.rstrip("/") + "/").alias("root")) for i, s in enumerate(specs)])
    return (
        listing.select("path", F.inline(F.filter(roots, lambda r: F.col("path").startswith(r["root"]))))
        .select("spec_no", "root", F.split(F.substr("path", F.length("root") + 1), "/").alias("_steps"))
        .select("spec_no", "root", F.element_at("_steps", 1).alias("entry"), (F.size("_steps") > 1).alias("is_dir"))
        .distinct()
    )


def curated_annotations(samples: DataFrame, listing: DataFrame, specs: Sequence[AnnotationSpec]) -> DataFrame:
    """One row per sample and spec: the annotation found, or null, and whether a required one is missing.

    `<id>.json` goes before a folder of that name, that before a plain file. `specs` comes
    from one manifest; it is expanded inside each row, not joined.
    """
    level = _first_level(listing, specs)
    by_name = level.select(
        "spec_no", F.col("entry").alias("sample_id"), F.when(F.col("is_dir"), 2).otherwise(3).alias("_rank"),
        F.concat("root", "entry").alias("match_path"),
    )
    by_json = level.where(~F.col("is_dir") & F.col("entry").endswith(".json")).select(
        "spec_no", F.regexp_replace("entry", r"\.json$", "").alias("sample_id"), F.lit(1).alias("_rank"),
        F.concat("root", "entry").alias("match_path"),
    )
    best = by_name.unionByName(by_json).groupBy("spec_no", "sample_id").agg(F.min_by("match_path", "_rank").alias("match_path"))
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("spec_no"), F.lit(s.label).alias("label"), F.lit(s.required).alias("required"),
                F.lit(s.task_type).cast("string").alias("task_type"),
            )
            for i, s in enumerate(specs)
        ]
    )
    wanted = samples.select("sample_id").distinct().select("sample_id", F.inline(entries))
    return wanted.join(best, ["spec_no", "sample_id"], "left").select(
        "sample_id", "spec_no", "label", "task_type", "match_path",
        (F.col("required") & F.col("match_path").isNull()).alias("missing_required"),
    )


def missing_annotations(matched: DataFrame) -> DataFrame:
    """Labels of the missing required annotations per sample; bounded by the manifest's list."""
    gaps = matched.where("missing_required").groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("spec_no", "label"))).alias("_gaps"))
    return gaps.select("sample_id", F.array_join(F.transform("_gaps", lambda g: g["label"]), ", ").alias("missing_annotations"))
