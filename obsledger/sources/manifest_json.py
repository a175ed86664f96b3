"""Curated uploads described by JSON text: specs, errors, and data files with their annotations.

A manifest is `{"data": path or {"path": path}, "annotation": [{"path", "name", "required", "task_type"}, …]}`. It
is read as a variant, so entries of any kind can be told apart; nothing is cast before its kind is known.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.rules import normalized_path
from obsledger.session import written

ERROR = ["manifest_path", "path", "error_code", "error_detail"]


@dataclass(frozen=True)
class Manifests:
    """What a table of manifests says.

    `data`: manifest_path, manifest_dir, data_root of those that can be used; `specs`: manifest_path, spec_no, root,
    source_path, label, required, task_type; `pending`: manifest_path, spec_no, label of required
    specs that have no root; `errors`: manifest_path, path, error_code, error_detail.
    """

    data: DataFrame
    specs: DataFrame
    pending: DataFrame
    errors: DataFrame


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN or a number's type; null for a JSON null or nothing."""
    kind = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return F.when(v.isNotNull() & ~F.is_variant_null(v), kind)


def _part(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _text(v: Column) -> Column:
    """The value if it is a string."""
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _is_set(v: Column) -> Column:
    """False for nothing, null, false, zero and what is empty, as a condition on the value would be."""
    kind = _kind(v)
    filled = F.when(kind == "STRING", F.length(_text(v)) > 0).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
    filled = filled.when(kind.isin("OBJECT", "ARRAY"), ~F.to_json(v).isin("{}", "[]"))
    return F.coalesce(filled.otherwise(F.try_variant_get(v, "$", "double") != 0), F.lit(False))


def _blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def _last_step(path: Column) -> Column:
    """Name of a path's last step; empty for the folder itself."""
    steps = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    return F.coalesce(F.try_element_at(steps, F.lit(-1)), F.lit(""))


def _resolved(path: Column, folder: Column) -> Column:
    return normalized_path(F.when(path.startswith("/"), path).otherwise(F.concat(folder, F.lit("/"), path)))


def _allowed(path: Column, roots: Sequence[str]) -> Column:
    below = F.lit(False)
    for root in roots:
        clean = root.rstrip("/")
        below = below | (path == clean) | path.startswith(clean + "/")
    return below


def _below(path: Column, folder: Column) -> Column:
    """What follows `folder` in a path below it, else null."""
    prefix = F.concat(folder, F.lit("/"))
    return F.when(F.startswith(path, prefix), F.substr(path, F.length(prefix) + 1))


def folder_tree(listing: DataFrame) -> DataFrame:
    """Rows (folder, entry, is_dir, path, byte_size): each file below each of its folders, by the step that leads to it."""
    steps = F.split("path", "/")
    files = listing.where(F.startswith("path", F.lit("/"))).select("path", "byte_size", steps.alias("_steps"))
    files = files.withColumn("_at", F.explode(F.sequence(F.lit(1), F.size("_steps") - 1)))
    folder = F.concat_ws("/", F.slice("_steps", 1, F.col("_at")))
    return files.select(
        folder.alias("folder"), F.element_at("_steps", F.col("_at") + 1).alias("entry"),
        (F.col("_at") + 1 < F.size("_steps")).alias("is_dir"), "path", "byte_size",
    )


def _with_place(rows: DataFrame, path: str, tree: DataFrame) -> DataFrame:
    """Add `place`: dir, file, or null where nothing lies at the path."""
    wanted = rows.select(F.col(path).alias("_place")).where("_place IS NOT NULL").distinct()
    here = F.concat("folder", F.lit("/"), "entry")
    found = tree.select(here.alias("_place"), "is_dir").join(wanted, "_place").groupBy("_place").agg(F.max("is_dir").alias("_dir"))
    joined = rows.join(found, F.col(path) == F.col("_place"), "left")
    return joined.withColumn("place", F.when(F.col("_dir"), "dir").when(~F.col("_dir"), "file")).drop("_place", "_dir")


def _failed(rows: DataFrame, path: Column) -> DataFrame:
    return rows.where("code IS NOT NULL").select("manifest_path", path.alias("path"), F.col("code").alias("error_code"), F.col("detail").alias("error_detail"))


def read_manifests(manifests: DataFrame, listing: DataFrame, allowed_roots: Sequence[str]) -> Manifests:
    """Manifests (manifest_path, content as JSON text) against the files that exist (path, byte_size).

    A manifest fails as a whole when it is unreadable (null), no JSON object, or its data folder is
    missing in it, outside the roots, not there or no folder; then it has that error alone.
    Entries of `annotation` fail one by one. Relative paths start at the manifest's folder and are
    resolved as text; symbolic links are not followed. Paths in errors are as the manifest has them.
    Manifests and entries are looked up in the listing once and stored, a row each.
    """
    tree, name = folder_tree(listing), _last_step(F.col("manifest_path"))
    parsed = manifests.select(
        "manifest_path", F.regexp_replace("manifest_path", "/[^/]*$", "").alias("manifest_dir"),
        F.col("content").isNull().alias("unreadable"), F.try_parse_json("content").alias("payload"),
    )
    data = _part(F.col("payload"), "$.data")
    read = parsed.select(
        "*", _kind(F.col("payload")).alias("root_kind"), _kind(data).alias("data_kind"),
        F.when(_kind(data) == "OBJECT", _text(_part(data, "$.path"))).otherwise(_text(data)).alias("data_path"),
        _part(F.col("payload"), "$.annotation").alias("annotation"),
    )
    read = read.withColumn("data_root", F.when(~_blank(F.col("data_path")), _resolved(F.col("data_path"), F.col("manifest_dir"))))
    read = _with_place(read, "data_root", tree)
    reasons = [
        (F.col("unreadable"), V.MANIFEST_UNREADABLE, "manifest unreadable"),
        (F.col("payload").isNull(), V.MANIFEST_INVALID, "manifest is not valid JSON"),
        (~F.col("root_kind").eqNullSafe("OBJECT"), V.MANIFEST_INVALID, "manifest root must be an object"),
        (F.col("data_kind").isNull(), V.MANIFEST_NO_DATA, "manifest missing data path"),
        (F.col("data_root").isNull(), V.MANIFEST_NO_DATA, "manifest data path is empty"),
        (~_allowed(F.col("data_root"), allowed_roots), V.DATA_OUTSIDE_ROOT, "path outside allowed roots"),
        (F.col("place").isNull(), V.DATA_INVALID, "path does not exist"),
        (F.col("place") != "dir", V.DATA_INVALID, "path is not a directory"),
    ]
    read = read.withColumns({"code": _first_of(reasons, 1), "detail": _first_of(reasons, 2)}).drop("unreadable", "payload")
    read = written(read, "manifests")
    usable = read.where("code IS NULL").drop("code", "detail", "place")

    kind = _kind(F.col("annotation"))
    no_list = usable.where(_is_set(F.col("annotation")) & (kind != "ARRAY")).select(
        "manifest_path", F.lit(V.MANIFEST_INVALID).alias("code"), F.lit("annotation must be a list").alias("detail")
    )
    lists = usable.where(kind == "ARRAY").select("manifest_path", "manifest_dir", "annotation")
    entries = lists.lateralJoin(lists.sparkSession.tvf.variant_explode(F.col("annotation").outer())).select(
        "manifest_path", "manifest_dir", F.col("pos").alias("spec_no"), F.col("value").alias("entry")
    )
    part = lambda key: _part(F.col("entry"), f"$.{key}")
    entries = entries.select(
        "manifest_path", "manifest_dir", "spec_no", _kind(F.col("entry")).eqNullSafe("OBJECT").alias("is_object"),
        _text(part("path")).alias("path"), _is_set(part("required")).alias("required"),
        F.when(_is_set(part("name")), _text(part("name"))).otherwise(_text(part("label_name"))).alias("label"),
        F.nullif(F.trim(_text(part("task_type"))), F.lit("")).alias("task_type"),
    )
    entries = entries.withColumn("root", F.when(~_blank(F.col("path")), _resolved(F.col("path"), F.col("manifest_dir"))))
    entries = _with_place(entries.withColumn("label", F.coalesce("label", _last_step(F.col("path")))), "root", tree)
    at = lambda end: F.concat(F.lit("annotation["), F.col("spec_no").cast("string"), F.lit(f"] {end}"))
    reasons = [
        (~F.col("is_object"), V.MANIFEST_INVALID, at("must be an object")),
        (F.col("root").isNull(), V.MANIFEST_INVALID, at("missing path")),
        (~_allowed(F.col("root"), allowed_roots), V.ANNOTATION_OUTSIDE_ROOT, "path outside allowed roots"),
        (F.col("place").isNull(), V.ANNOTATION_NOT_FOUND, "annotation path does not exist"),
    ]
    entries = written(entries.withColumns({"code": _first_of(reasons, 1), "detail": _first_of(reasons, 2)}), "manifest-entries")
    own = F.coalesce(_below(F.col("root"), F.col("manifest_dir")), _last_step(F.col("root")))
    label = F.when(F.col("label") == "", _last_step(F.col("root"))).otherwise(F.col("label"))
    specs = entries.where("code IS NULL").select("manifest_path", "spec_no", "root", own.alias("source_path"), label.alias("label"), "required", "task_type")
    pending = entries.where(F.col("required") & F.col("code").isin(V.ANNOTATION_OUTSIDE_ROOT, V.ANNOTATION_NOT_FOUND))
    errors = _failed(read, name).unionByName(_failed(no_list, name))
    errors = errors.unionByName(_failed(entries, F.when(F.col("code") == V.MANIFEST_INVALID, name).otherwise(F.col("path"))))
    return Manifests(usable.select("manifest_path", "manifest_dir", "data_root"), specs, pending.select("manifest_path", "spec_no", "label"), errors)


def _first_of(reasons: list, field: int) -> Column:
    result = F.lit(None).cast("string")
    for reason in reversed(reasons):
        result = F.when(reason[0], reason[field]).otherwise(result)
    return result


def data_files(data: DataFrame, listing: DataFrame) -> DataFrame:
    """Files below the data folders: manifest_path, manifest_dir, relative_path, byte_size, sample_id, repeated.

    A sample is the first folder below the data folder, or the stem of a file that lies in it; `repeated`
    marks ids that two of these share.
    """
    files = data.join(folder_tree(listing), F.col("data_root") == F.col("folder"))
    stem = F.regexp_replace("entry", r"(?<=.)\.[^.]+$", "")
    files = files.select(
        "manifest_path", "manifest_dir", F.coalesce(_below(F.col("path"), F.col("manifest_dir")), _below(F.col("path"), F.col("data_root"))).alias("relative_path"),
        "byte_size", F.when(F.col("is_dir"), F.col("entry")).otherwise(stem).alias("sample_id"),
        F.concat(F.when(F.col("is_dir"), "dir:").otherwise("file:"), "entry").alias("container"),
    )
    keys = ["manifest_path", "sample_id"]
    repeated = files.groupBy(*keys).agg((F.min("container") != F.max("container")).alias("repeated")).where("repeated")
    return files.drop("container").join(repeated, keys, "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))


def matched_specs(samples: DataFrame, manifests: Manifests, listing: DataFrame) -> DataFrame:
    """Rows (manifest_path, sample_id, spec_no, label, task_type, required, match_path): each sample with each spec of its manifest.

    `<id>.json` goes before a folder or file named like the sample; no match gives a null path.
    """
    roots = manifests.specs.select(F.col("root").alias("folder")).distinct()
    level = folder_tree(listing).join(roots, "folder").groupBy("folder", "entry").agg(F.max("is_dir").alias("is_dir"))
    named = level.select(F.col("folder").alias("root"), F.col("entry").alias("sample_id"), F.lit(2).alias("_rank"), "entry")
    stored = level.where(~F.col("is_dir") & F.col("entry").endswith(".json"))
    stored = stored.select(F.col("folder").alias("root"), F.regexp_replace("entry", r"\.json$", "").alias("sample_id"), F.lit(1).alias("_rank"), "entry")
    best = named.unionByName(stored).groupBy("root", "sample_id").agg(F.min_by("entry", "_rank").alias("entry"))
    wanted = samples.select("manifest_path", "manifest_dir", "sample_id").distinct().join(manifests.specs, "manifest_path")
    full = F.concat("root", F.lit("/"), "entry")
    own = F.coalesce(_below(full, F.col("manifest_dir")), F.concat("source_path", F.lit("/"), "entry"))
    return wanted.join(best, ["root", "sample_id"], "left").select(
        "manifest_path", "sample_id", "spec_no", "label", "task_type", "required", F.when(F.col("entry").isNotNull(), own).alias("match_path")
    )


def curated_items(manifests: Manifests, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of all manifests, and their errors (those of `manifests` and of repeated sample ids).

    Items: manifest_path, relative_path, byte_size, sample_id, annotations (spec_no, path, label, task_type, required; as
    many as the manifest has entries) and missing, the labels of required annotations that are not
    there. Labels of required specs without a root are missing for every sample.
    """
    files = data_files(manifests.data, listing)
    twice = files.where("repeated").select(
        "manifest_path", F.col("relative_path").alias("path"), F.lit(V.DUPLICATE_SAMPLE).alias("error_code"), F.col("sample_id").alias("error_detail")
    )
    items = files.where("NOT repeated")
    found = F.struct("spec_no", F.col("match_path").alias("path"), "label", "task_type", "required")
    of_sample = matched_specs(items, manifests, listing).groupBy("manifest_path", "sample_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("match_path").isNotNull(), found))).alias("annotations"),
        F.sort_array(F.collect_list(F.when(F.col("required") & F.col("match_path").isNull(), F.struct("spec_no", "label")))).alias("_gaps"),
    )
    pending = manifests.pending.groupBy("manifest_path").agg(F.sort_array(F.collect_list(F.struct("spec_no", "label"))).alias("_pending"))
    joined = items.join(of_sample, ["manifest_path", "sample_id"], "left").join(pending, "manifest_path", "left")
    gaps = F.expr("coalesce(_gaps.label, cast(array() AS array<string>))")
    missing = F.when(F.col("_pending").isNull(), gaps).otherwise(F.array_distinct(F.concat(gaps, F.col("_pending.label"))))
    kind = "array<struct<spec_no: int, path: string, label: string, task_type: string, required: boolean>>"
    items = joined.select(
        "manifest_path", "relative_path", "byte_size", "sample_id",
        F.coalesce("annotations", F.expr(f"cast(array() AS {kind})")).alias("annotations"), missing.alias("missing"),
    )
    return items, manifests.errors.unionByName(twice)
