"""Ledger views over the given tables, once as Spark plans and once as SQL for the check.

`view(spark, sf_dir, name)` builds the Spark side with the DataFrame API. `with_views`
puts the SQL definitions that a check query needs in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions import values as V


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, choices: list) -> Column:
    """The `index`-th choice, counted from 0."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (index + 1).cast("int"))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


MODALITIES = ["CT", "MR", "DX", "US", "PT"]
SOP_CLASSES = [
    "1.2.840.10008.5.1.4.1.1.2",
    "1.2.840.10008.5.1.4.1.1.4",
    "1.2.840.10008.5.1.4.1.1.1.1",
    "1.2.840.10008.5.1.4.1.1.6.1",
    "1.2.840.10008.5.1.4.1.1.128",
]
MAKERS = [
    "SIEMENS HEALTHINEERS", "GE Healthcare", "Philips Medical", "United Imaging", "联影",
    "TOSHIBA", "Hitachi", "Agfa", "Carestream Health", "FUJI", "Acme Imaging / North",
]
STAGES = ["scan", "parse", "storage", "metadata_persistence", "validation", "binding", "indexing"]


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A table, a file or a folder of files, as a stream; all that is there in one batch unless told otherwise.

    A table that is not there is an error.
    """
    location = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    if status.isDirectory():
        return reader.parquet(location)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)  # a stream's path is a folder


def observations(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per upload of an instance."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    uid = F.concat(F.lit("1.2.826."), F.col("l_orderkey").cast("string"))
    quantity = F.col("l_quantity").cast("int").cast("string")
    step = F.pmod("l_linenumber", F.lit(5))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.md5(
            F.concat_ws(
                "|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                money("l_quantity"), money("l_extendedprice"), money("l_discount"), money("l_tax"),
                "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").cast("string"),
            )
        ).alias("observation_id"),
        F.concat(uid, F.lit("."), F.col("l_linenumber").cast("string")).alias("sop_instance_uid"),
        uid.alias("series_instance_uid"),
        F.concat(F.lit("1.2.826.0."), F.col("o_custkey").cast("string")).alias("study_instance_uid"),
        F.year("l_shipdate").alias("job_id"),
        F.col("l_shipdate").cast("date").alias("observed_at"),
        F.sha2(F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), quantity), 256)
        .alias("whole_file_sha256"),
        F.when(F.col("l_suppkey") % 40 != 0, F.md5(F.concat_ws("|", F.col("l_partkey").cast("string"), quantity)))
        .alias("pixel_digest"),
        pick(step, MODALITIES).alias("modality"),
        pick(step, SOP_CLASSES).alias("sop_class_uid"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
        F.concat(F.lit("Customer^"), F.col("o_custkey").cast("string")).alias("patient_name"),
        F.col("o_orderdate").cast("date").alias("study_date"),
        F.when(F.col("l_linenumber") == 6, F.lit("n/a")).otherwise(F.col("l_linenumber").cast("string"))
        .alias("instance_number"),
        (F.col("l_returnflag") != "N").alias("has_pixel_data"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


OBSERVATIONS_SQL = f"""
SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR),
         l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS observation_id,
       '1.2.826.' || l_orderkey || '.' || l_linenumber AS sop_instance_uid,
       '1.2.826.' || l_orderkey AS series_instance_uid,
       '1.2.826.0.' || o_custkey AS study_instance_uid,
       CAST(year(l_shipdate) AS INTEGER) AS job_id,
       CAST(l_shipdate AS DATE) AS observed_at,
       sha256(concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))) AS whole_file_sha256,
       CASE WHEN l_suppkey % 40 <> 0 THEN md5(concat_ws('|', CAST(l_partkey AS VARCHAR),
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))) END AS pixel_digest,
       {MODALITIES!r}[l_linenumber % 5 + 1] AS modality,
       {SOP_CLASSES!r}[l_linenumber % 5 + 1] AS sop_class_uid,
       'P' || o_custkey AS patient_id, 'Customer^' || o_custkey AS patient_name,
       CAST(o_orderdate AS DATE) AS study_date,
       CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END AS instance_number,
       l_returnflag <> 'N' AS has_pixel_data,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# Header tags of an observation; null = tag absent, '' = tag present but empty.
TAG_SQL = {
    "SOPClassUID": "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE sop_class_uid END",
    "SOPInstanceUID": "CASE WHEN l_suppkey % 97 = 0 THEN '' ELSE sop_instance_uid END",
    "StudyInstanceUID": "study_instance_uid",
    "SeriesInstanceUID": "CASE WHEN l_partkey % 59 = 0 THEN '' ELSE series_instance_uid END",
    "PatientID": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE patient_id END",
    "PatientName": "patient_name",
    "StudyDate": "replace(CAST(study_date AS {text}), '-', '')",
    "StudyTime": "CASE WHEN l_orderkey % 2 = 0 THEN '120000' END",
    "Modality": "lower(modality)",
    "SeriesNumber": "CAST(l_linenumber AS {text})",
    "InstanceNumber": "instance_number",
    "TransferSyntaxUID": "CASE WHEN l_partkey % 3 = 0 THEN '' ELSE '1.2.840.10008.1.2.1' END",
    "Manufacturer": "{makers}",
    "ManufacturerModelName": "CASE WHEN l_partkey % 4 = 0 THEN NULL WHEN l_partkey % 4 = 1 THEN 'GENERIC' "
    "ELSE 'Model ' || CAST(l_partkey AS {text}) || '/' || substring(observation_id, 1, 6) || '+dual source'  END",
    "SeriesDescription": "CASE WHEN l_partkey % 6 = 0 THEN 'axial meas_uid= ' || substring(pixel_digest, 1, 20) "
    "WHEN l_partkey % 6 = 1 THEN '测量ID:' || substring(pixel_digest, 1, 12) END",
    "ImageComments": "CASE WHEN l_partkey % 7 = 0 THEN 'see \"MeasUID\" : \"' || substring(pixel_digest, 1, 4) || '-1\"' END",
    "PixelData": "CASE WHEN has_pixel_data THEN '1' END",
}


def _tag_sql(engine: str) -> dict[str, str]:
    if engine == "spark":
        makers = "element_at(array(" + ", ".join(f"'{m}'" for m in MAKERS) + "), CAST(l_suppkey % 11 AS INT) + 1)"
        return {k: v.format(text="STRING", makers=makers) for k, v in TAG_SQL.items()}
    makers = "[" + ", ".join(f"'{m}'" for m in MAKERS) + "][l_suppkey % 11 + 1]"
    return {k: v.format(text="VARCHAR", makers=makers) for k, v in TAG_SQL.items()}


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header tags per observation, one column per tag."""
    obs = observations(spark, sf_dir)
    return obs.select("observation_id", *[F.expr(sql).alias(tag) for tag, sql in _tag_sql("spark").items()])


TAGS_SQL = (
    "SELECT observation_id, "
    + ", ".join(f'{sql} AS "{tag}"' for tag, sql in _tag_sql("duckdb").items())
    + " FROM v_obs"
)


def tag_map(df: DataFrame, names: list[str] | None = None) -> Column:
    """Map of the tags that are present."""
    names = names or [c for c in df.columns if c != "observation_id"]
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def vendor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Private header blocks of the first two vendors, as text."""
    digest = F.col("pixel_digest")
    k = F.pmod("l_partkey", F.lit(8))
    return observations(spark, sf_dir).select(
        "observation_id",
        "modality",
        F.when(F.col("l_suppkey") % 2 == 0, "Siemens Healthcare").otherwise("UIH").alias("manufacturer"),
        F.when(k == 0, F.concat(F.lit("CSA MeasUID: "), F.substring(digest, 1, 20)))
        .when(k == 1, F.lit("no id here")).alias("block1"),
        F.when(k.isin(1, 2), F.concat(F.lit('{"MeasUID" : "'), F.substring(digest, 1, 6), F.lit('"}'))).alias("block2"),
        F.when(k == 3, F.concat(F.lit("MeasUID== "), F.substring(digest, 1, 4))).alias("block3"),
        F.when(k == 4, F.concat(F.lit("MeasUID:\t"), F.substring(digest, 5, 8), F.lit("-"), F.substring(digest, 13, 9)))
        .alias("block4"),
        F.when(k == 5, F.concat(F.lit("Meas-UID="), F.substring(digest, 1, 16))).alias("block5"),
        F.when(k == 6, F.concat(F.lit("meas_uid: "), F.substring(digest, 1, 10), F.lit("-ab"))).alias("series_description"),
        F.when(k == 7, F.concat(F.lit("MEASUID "), F.substring(digest, 1, 18))).alias("image_comments"),
    )


VENDOR_BLOCKS_SQL = """
SELECT observation_id, modality,
       CASE WHEN l_suppkey % 2 = 0 THEN 'Siemens Healthcare' ELSE 'UIH' END AS manufacturer,
       CASE WHEN l_partkey % 8 = 0 THEN 'CSA MeasUID: ' || substr(pixel_digest, 1, 20)
            WHEN l_partkey % 8 = 1 THEN 'no id here' END AS block1,
       CASE WHEN l_partkey % 8 IN (1, 2) THEN '{"MeasUID" : "' || substr(pixel_digest, 1, 6) || '"}' END AS block2,
       CASE WHEN l_partkey % 8 = 3 THEN 'MeasUID== ' || substr(pixel_digest, 1, 4) END AS block3,
       CASE WHEN l_partkey % 8 = 4 THEN 'MeasUID:' || chr(9) || substr(pixel_digest, 5, 8) || '-' || substr(pixel_digest, 13, 9) END AS block4,
       CASE WHEN l_partkey % 8 = 5 THEN 'Meas-UID=' || substr(pixel_digest, 1, 16) END AS block5,
       CASE WHEN l_partkey % 8 = 6 THEN 'meas_uid: ' || substr(pixel_digest, 1, 10) || '-ab' END AS series_description,
       CASE WHEN l_partkey % 8 = 7 THEN 'MEASUID ' || substr(pixel_digest, 1, 18) END AS image_comments
FROM v_obs"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate files with outcome, seven status axes, error and storage columns."""
    docs = table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256)).drop("text")
    df = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    doc = F.col("doc_id")
    path = F.concat("lang", F.lit("/"), "source", F.lit("/"), doc.cast("string"), F.lit(".dcm"))
    outcome = (
        F.when(F.col("quality").isNull(), None)
        .when(doc % 7 == 0, "failed")
        .when(F.col("toxic") == 1, "quarantined")
        .when(F.col("quality") == 1, "accepted")
        .otherwise("rejected")
    )
    code = F.when(F.col("outcome") == "failed", V.STORAGE_FAILED).when(
        F.col("outcome") == "rejected",
        pick(doc % 4, [V.NOT_IMAGE, V.PARSE_FAILED, V.MISSING_TAG, ""]),
    )
    uri = (
        F.when(F.col("outcome") == "accepted",
               F.when(doc % 2 == 0, F.concat(F.lit("local-nas://default/"), "source_path"))
               .otherwise(F.concat(F.lit("s3://ledger/"), "sha")))
        .when((F.col("outcome") == "failed") & (doc % 2 == 0), F.concat(F.lit("s3://ledger/"), "sha"))
        .when(F.col("outcome").isNull() & (doc % 4 != 0), F.concat(F.lit("local-nas://default/"), "source_path"))
    )
    df = df.select(
        doc.alias("item_id"), F.col("source").alias("job_id"), path.alias("source_path"), "lang",
        F.col("n_chars").alias("byte_size"), F.col("sha").alias("whole_file_sha256"), outcome.alias("outcome"),
        "doc_id", "sha",
    ).withColumn("error_code", code)
    df = df.select(
        "item_id", "job_id", "source_path", "lang", "byte_size", "whole_file_sha256", "outcome", "error_code",
        F.when(F.col("error_code").isNotNull() & (doc % 3 != 0), F.concat(F.lit("stopped at /srv/in/"), "source_path"))
        .alias("error_detail"),
        uri.alias("storage_uri"),
        F.when(F.col("outcome") == "failed", "storage")
        .when(F.col("outcome").isNull() & (doc % 10 == 3), "parse").alias("last_retryable_stage"),
        *_axes(doc),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id AS INT), 0)").alias("created_at"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id AS INT), byte_size)").alias("updated_at"),
    )
    return df


# status per axis for pending items, by doc_id % 5
_PENDING = [
    ["pending"] * 7,
    ["completed", "in_progress"] + ["pending"] * 5,
    ["completed", "failed"] + ["pending"] * 5,
    ["completed", "completed", "completed", "in_progress"] + ["pending"] * 3,
    ["completed", "awaiting_retry"] + ["pending"] * 5,
]
_FAILED = ["completed", "completed", "failed"] + ["pending"] * 4
_REJECTED = ["completed", "failed"] + ["rejected"] * 5
_NOT_IMAGE = ["rejected"] * 7


def _axes(doc: Column) -> list[Column]:
    return [
        F.when(F.col("outcome") == "accepted", "completed")
        .when(F.col("outcome") == "quarantined", "completed" if i != 4 else "quarantined")
        .when(F.col("outcome") == "failed", _FAILED[i])
        .when(F.col("error_code") == V.NOT_IMAGE, _NOT_IMAGE[i])
        .when(F.col("outcome") == "rejected", _REJECTED[i])
        .otherwise(pick(doc % 5, [row[i] for row in _PENDING])).alias(axis)
        for i, axis in enumerate(V.AXES)
    ]


def _axes_sql() -> str:
    return ",\n".join(
        f"""CASE WHEN outcome = 'accepted' THEN 'completed'
            WHEN outcome = 'quarantined' THEN '{"completed" if i != 4 else "quarantined"}'
            WHEN outcome = 'failed' THEN '{_FAILED[i]}'
            WHEN error_code = '{V.NOT_IMAGE}' THEN '{_NOT_IMAGE[i]}'
            WHEN outcome = 'rejected' THEN '{_REJECTED[i]}'
            ELSE {[row[i] for row in _PENDING]!r}[item_id % 5 + 1] END AS {axis}"""
        for i, axis in enumerate(V.AXES)
    )


ITEMS_SQL = f"""
SELECT item_id, job_id, source_path, lang, byte_size, whole_file_sha256, outcome, error_code,
       CASE WHEN error_code IS NOT NULL AND item_id % 3 <> 0 THEN 'stopped at /srv/in/' || source_path END AS error_detail,
       CASE WHEN outcome = 'accepted' AND item_id % 2 = 0 THEN 'local-nas://default/' || source_path
            WHEN outcome = 'accepted' THEN 's3://ledger/' || whole_file_sha256
            WHEN outcome = 'failed' AND item_id % 2 = 0 THEN 's3://ledger/' || whole_file_sha256
            WHEN outcome IS NULL AND item_id % 4 <> 0 THEN 'local-nas://default/' || source_path END AS storage_uri,
       CASE WHEN outcome = 'failed' THEN 'storage'
            WHEN outcome IS NULL AND item_id % 10 = 3 THEN 'parse' END AS last_retryable_stage,
       {_axes_sql()},
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(item_id) AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(item_id) + to_seconds(byte_size) AS updated_at
FROM (SELECT *, CASE WHEN outcome = 'failed' THEN '{V.STORAGE_FAILED}'
                     WHEN outcome = 'rejected' THEN ['{V.NOT_IMAGE}', '{V.PARSE_FAILED}', '{V.MISSING_TAG}', ''][item_id % 4 + 1]
                END AS error_code
      FROM (SELECT d.doc_id AS item_id, source AS job_id, lang || '/' || source || '/' || d.doc_id || '.dcm' AS source_path,
                   lang, n_chars AS byte_size, sha256(text) AS whole_file_sha256,
                   CASE WHEN quality IS NULL THEN NULL WHEN d.doc_id % 7 = 0 THEN 'failed'
                        WHEN toxic = 1 THEN 'quarantined' WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS outcome
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload jobs of the items."""
    number = F.substring("job_id", 4, 10).cast("int")
    return (
        items(spark, sf_dir).groupBy("job_id")
        .agg(F.min("created_at").alias("created_at"), F.max("updated_at").alias("last_update"))
        .select(
            "job_id", F.concat(F.lit("actor"), (number % 3).cast("string")).alias("actor_id"),
            pick(number % 2, ["local_folder", "curated_manifest"]).alias("source_type"),
            pick(number % 5, ["completed", "processing", "failed", "completed", "cancelled"]).alias("status"),
            "created_at",
            F.when(number % 5 != 1, F.col("last_update")).alias("finished_at"),
        )
    )


JOBS_SQL = """
SELECT job_id, 'actor' || (CAST(substr(job_id, 4) AS INTEGER) % 3) AS actor_id,
       ['local_folder', 'curated_manifest'][CAST(substr(job_id, 4) AS INTEGER) % 2 + 1] AS source_type,
       ['completed', 'processing', 'failed', 'completed', 'cancelled'][CAST(substr(job_id, 4) AS INTEGER) % 5 + 1] AS status,
       min(created_at) AS created_at,
       CASE WHEN CAST(substr(job_id, 4) AS INTEGER) % 5 <> 1 THEN max(updated_at) END AS finished_at
FROM v_item GROUP BY job_id"""


def events(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Stage events: who did what to which item, when, how long it took and how it ended."""
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "in_progress")
        .when(F.col("event_type") == "view", "pending")
        .otherwise("completed")
    )
    rows = table(spark, sf_dir, "events") if rows is None else rows
    return rows.select(
        "event_id", "ts", F.col("user_id").alias("job_id"), "event_type", F.col("value").alias("duration_ms"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        pick(F.col("event_id") % 7, STAGES).alias("stage"),
        pick(F.col("event_id") % 7, V.AXES).alias("axis"),
        status.alias("status"),
        F.when(F.col("event_type") == "error", pick(F.col("event_id") % 3, [V.PARSE_FAILED, V.STORAGE_FAILED, V.MISSING_TAG]))
        .alias("error_code"),
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "purchase", "accepted")
        .when(F.col("event_type") == "signup", "rejected").alias("outcome"),
    )


EVENTS_SQL = f"""
SELECT event_id, ts, user_id AS job_id, event_type, value AS duration_ms,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       {STAGES!r}[event_id % 7 + 1] AS stage, {V.AXES!r}[event_id % 7 + 1] AS axis,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'in_progress' WHEN 'view' THEN 'pending'
            ELSE 'completed' END AS status,
       CASE WHEN event_type = 'error' THEN ['{V.PARSE_FAILED}', '{V.STORAGE_FAILED}', '{V.MISSING_TAG}'][event_id % 3 + 1] END AS error_code,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'accepted' WHEN 'signup' THEN 'rejected' END AS outcome
FROM events"""


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second upload of every series that covers every conflict class.

    By order number: unchanged; even lines under a new series; odd lines with another
    hash; every instance under another UID.
    """
    group = F.pmod("l_orderkey", F.lit(4))
    odd = F.col("l_linenumber") % 2 == 1
    series, sop = F.col("series_instance_uid"), F.col("sop_instance_uid")
    return stored_instances(spark, sf_dir).select(
        F.concat(F.lit("job"), F.pmod("l_orderkey", F.lit(7)).cast("string")).alias("job_id"),
        F.when((group == 1) & ~odd, F.concat(series, F.lit(".2"))).otherwise(series).alias("series_instance_uid"),
        F.when(group == 3, F.concat(sop, F.lit(".9"))).otherwise(sop).alias("sop_instance_uid"),
        F.when((group == 2) & odd, F.md5(F.concat("sha", F.lit("x"))))
        .when((group == 0) & (F.col("l_linenumber") == 5), None)
        .otherwise(F.col("sha")).alias("sha"),
    )


def stored_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored series content for the conflict queries: one hash per instance."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.md5(F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                          F.col("l_quantity").cast("int").cast("string"))).alias("sha"),
    )
    uid = F.concat(F.lit("1.2.826."), F.col("l_orderkey").cast("string"))
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.min("sha").alias("sha")).select(
        "l_orderkey", "l_linenumber", uid.alias("series_instance_uid"),
        F.concat(uid, F.lit("."), F.col("l_linenumber").cast("string")).alias("sop_instance_uid"), "sha",
    )


STORED_SQL = """
SELECT l_orderkey, l_linenumber, '1.2.826.' || l_orderkey AS series_instance_uid,
       '1.2.826.' || l_orderkey || '.' || l_linenumber AS sop_instance_uid,
       min(md5(concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)))) AS sha
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

UPLOADS_SQL = """
SELECT 'job' || (l_orderkey % 7) AS job_id,
       CASE WHEN l_orderkey % 4 = 1 AND l_linenumber % 2 = 0 THEN series_instance_uid || '.2' ELSE series_instance_uid END AS series_instance_uid,
       CASE WHEN l_orderkey % 4 = 3 THEN sop_instance_uid || '.9' ELSE sop_instance_uid END AS sop_instance_uid,
       CASE WHEN l_orderkey % 4 = 2 AND l_linenumber % 2 = 1 THEN md5(sha || 'x')
            WHEN l_orderkey % 4 = 0 AND l_linenumber = 5 THEN NULL ELSE sha END AS sha
FROM v_stored"""


def instances(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    """Known instances with their series and study, no attributes."""
    obs = observations(spark, sf_dir) if obs is None else obs
    return obs.select(
        "sop_instance_uid", "series_instance_uid", "study_instance_uid", "l_orderkey", "l_linenumber"
    ).distinct()


INSTANCES_SQL = """
SELECT DISTINCT sop_instance_uid, series_instance_uid, study_instance_uid, l_orderkey, l_linenumber FROM v_obs"""


def edges(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    """References from instances to other instances, series and studies."""
    nxt = (F.col("l_orderkey") + 1).cast("string")
    line = F.col("l_linenumber")
    return instances(spark, sf_dir, obs).select(
        F.col("sop_instance_uid").alias("from_sop"),
        pick(line % 7, V.RELATIONSHIPS).alias("relationship"),
        F.when((line % 3 != 1) | (line % 2 == 0), F.concat(F.lit("1.2.826.0."), (F.col("l_orderkey") * 7 % 2000).cast("string"))).alias("to_study"),
        F.when(line % 3 != 2, F.concat(F.lit("1.2.826."), nxt)).alias("to_series"),
        F.when(line % 3 == 0, F.concat(F.lit("1.2.826."), nxt, F.lit("."), line.cast("string"))).alias("to_sop"),
        F.when(line % 4 == 0, line).alias("frame_number"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("l_orderkey", F.lit(365)).cast("int")).alias("created_on"),
    )


EDGES_SQL = f"""
SELECT sop_instance_uid AS from_sop, {V.RELATIONSHIPS!r}[l_linenumber % 7 + 1] AS relationship,
       CASE WHEN l_linenumber % 3 <> 1 OR l_linenumber % 2 = 0 THEN '1.2.826.0.' || (l_orderkey * 7 % 2000) END AS to_study,
       CASE WHEN l_linenumber % 3 <> 2 THEN '1.2.826.' || (l_orderkey + 1) END AS to_series,
       CASE WHEN l_linenumber % 3 = 0 THEN '1.2.826.' || (l_orderkey + 1) || '.' || l_linenumber END AS to_sop,
       CASE WHEN l_linenumber % 4 = 0 THEN l_linenumber END AS frame_number,
       DATE '2024-01-01' + CAST(l_orderkey % 365 AS INTEGER) AS created_on
FROM v_inst"""


def private_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor-private tags with their raw bytes."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("obs"), (F.col("doc_id") % 97).cast("string")).alias("observation_id"),
        F.col("source").alias("creator"),
        F.concat(F.lit("(0029,"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(")")).alias("tag"),
        F.when(F.col("lang") == "en", "LO").when(F.col("lang") == "fr", "UT").when(F.col("lang") == "de", "OB")
        .otherwise("DS").alias("vr"),
        F.encode("text", "UTF-8").alias("raw_value"),
    )


PRIVATE_TAGS_SQL = """
SELECT 'obs' || (doc_id % 97) AS observation_id, source AS creator,
       '(0029,' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || ')' AS tag,
       CASE lang WHEN 'en' THEN 'LO' WHEN 'fr' THEN 'UT' WHEN 'de' THEN 'OB' ELSE 'DS' END AS vr,
       text AS raw_text
FROM documents"""


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload paths, good ones and every kind of bad one."""
    rest = F.regexp_replace("url", "^[a-z]+://", "")
    kind = F.col("page_id") % 10
    return table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.length("html").cast("bigint").alias("n_bytes"),
        F.when(kind == 0, F.concat(F.lit("../"), rest)).when(kind == 1, F.concat(F.lit("/"), rest))
        .when(kind == 2, F.concat(F.lit("a//"), rest)).when(kind == 3, F.concat(F.lit("~"), rest))
        .when(kind == 4, F.concat(F.lit("x"), F.char(F.lit(7)), rest)).when(kind == 5, F.concat(F.lit("a..b$"), rest))
        .when(kind == 6, "").when(kind == 7, F.concat(F.lit("a\\..\\"), rest))
        .otherwise(rest).alias("path"),
    )


PATHS_SQL = r"""
SELECT page_id, url, length(html) AS n_bytes,
       CASE page_id % 10 WHEN 0 THEN '../' || rest WHEN 1 THEN '/' || rest WHEN 2 THEN 'a//' || rest WHEN 3 THEN '~' || rest
            WHEN 4 THEN 'x' || chr(7) || rest WHEN 5 THEN 'a..b$' || rest WHEN 6 THEN '' WHEN 7 THEN 'a\..\' || rest ELSE rest END AS path
FROM (SELECT *, regexp_replace(url, '^[a-z]+://', '') AS rest FROM pages)"""


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes on observations, some of them deleted."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("observation_id"), F.col("turn").alias("seq"), F.col("role").alias("comment_type"),
        F.col("text").alias("body"), (F.col("turn") % 5 == 4).alias("deleted"),
    )


COMMENTS_SQL = """
SELECT conv_id AS observation_id, turn AS seq, role AS comment_type, text AS body, turn % 5 = 4 AS deleted FROM conversations"""


VIEW_SQL = {
    "v_obs": OBSERVATIONS_SQL,
    "v_tags": TAGS_SQL,
    "v_blocks": VENDOR_BLOCKS_SQL,
    "v_item": ITEMS_SQL,
    "v_job": JOBS_SQL,
    "v_event": EVENTS_SQL,
    "v_stored": STORED_SQL,
    "v_upload": UPLOADS_SQL,
    "v_inst": INSTANCES_SQL,
    "v_edge": EDGES_SQL,
    "v_ptag": PRIVATE_TAGS_SQL,
    "v_path": PATHS_SQL,
    "v_comment": COMMENTS_SQL,
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` behind a WITH list of the views it needs, directly or through other views."""
    known = {**VIEW_SQL, **(extra or {})}
    order: list[str] = []

    def need(sql: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b{name}\b", sql):
                need(known[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({known[n].strip()})" for n in order) + "\n" + body.strip()
