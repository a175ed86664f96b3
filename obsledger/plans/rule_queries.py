"""Queries over the per-row rules: tags, identifiers, paths, privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import paths as H
from obsledger.functions import privacy, rules
from obsledger.functions import values as V
from obsledger.operators import private_tags as T
from obsledger.operators.canonical import object_class_family
from obsledger.plans import fixtures as X
from obsledger.plans.canonical_queries import FAMILY_SQL
from obsledger.plans.registry import query
from obsledger.session import staged


def with_tags(spark, sf, names=None):
    df = X.tags(spark, sf)
    return df.select("observation_id", X.tag_map(df, names).alias("tags"))


def _missing(names) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce(\"{n}\", '') = '' THEN '{n}' END" for n in names) + ")"


@query("required_tags", f"""
SELECT observation_id, concat_ws(';', {", ".join(f"CASE WHEN coalesce({chr(34)}{n}{chr(34)}, '') <> '' THEN '{n}=' || {chr(34)}{n}{chr(34)} END" for n in sorted(V.IDENTITY_TAGS))}) AS kept,
       {_missing(V.MANDATORY_TAGS)} AS missing FROM v_tags""")
def required_tags(spark, sf):
    entries = F.array_sort(F.map_entries(rules.identity_tags(F.col("tags"))))
    kept = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    missing = F.array_join(rules.missing_of(F.col("tags"), V.MANDATORY_TAGS), ",")
    return with_tags(spark, sf).select("observation_id", kept.alias("kept"), missing.alias("missing"))


@query("json_tag_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS tag_value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def json_tag_extract(spark, sf):
    value = F.get_json_object("props", "$.k")
    return X.table(spark, sf, "events").select("event_id", value.alias("tag_value")).where("tag_value IS NOT NULL")


@query("tag_validation", f"""
SELECT observation_id, CASE WHEN {_missing(V.MANDATORY_TAGS)} <> '' THEN 'invalid' ELSE 'valid' END AS result,
       CASE WHEN {_missing(V.MANDATORY_TAGS)} <> '' THEN 'invalid' WHEN {_missing(V.RECOMMENDED_TAGS)} <> '' THEN 'incomplete' ELSE 'valid' END AS strict_result FROM v_tags""")
def tag_validation(spark, sf):
    tags = F.col("tags")
    return with_tags(spark, sf).select(
        "observation_id", rules.tag_validation(tags).alias("result"), rules.tag_validation(tags, strict=True).alias("strict_result")
    )


UIDS = {
    "v_uid": """SELECT observation_id, CASE l_partkey % 8 WHEN 0 THEN sop_instance_uid || '.' WHEN 1 THEN '.' || sop_instance_uid WHEN 2 THEN replace(sop_instance_uid, '.826.', '..826.')
        WHEN 3 THEN repeat(sop_instance_uid, 5) WHEN 4 THEN 'x' || sop_instance_uid WHEN 5 THEN '' WHEN 6 THEN CAST(l_partkey AS VARCHAR) ELSE sop_instance_uid END AS uid FROM v_obs""",
}


@query("uid_validation", """
SELECT observation_id, uid, regexp_matches(uid, '^[0-9]+(\\.[0-9]+)+$') AS dotted_number,
       CASE WHEN uid = '' THEN 'empty' ELSE concat_ws(',', CASE WHEN length(uid) > 64 THEN 'too_long' END,
         CASE WHEN NOT regexp_matches(uid, '^[0-9]+(\\.[0-9]+)*$') THEN 'invalid_characters' END, CASE WHEN uid LIKE '%..%' THEN 'consecutive_dots' END,
         CASE WHEN uid LIKE '.%' THEN 'starts_with_dot' END, CASE WHEN uid LIKE '%.' THEN 'ends_with_dot' END) END AS errors FROM v_uid""", UIDS)
def uid_validation(spark, sf):
    return X.observations(spark, sf).select("observation_id", broken_uid().alias("uid")).select(
        "observation_id", "uid", rules.is_dotted_number(F.col("uid")).alias("dotted_number"),
        F.array_join(rules.uid_errors(F.col("uid")), ",").alias("errors"),
    )


def broken_uid():
    """The instance UID, in most rows damaged."""
    sop, kind = F.col("sop_instance_uid"), F.col("l_partkey") % 8
    return (
        F.when(kind == 0, F.concat(sop, F.lit("."))).when(kind == 1, F.concat(F.lit("."), sop))
        .when(kind == 2, F.replace(sop, F.lit(".826."), F.lit("..826."))).when(kind == 3, F.repeat(sop, 5))
        .when(kind == 4, F.concat(F.lit("x"), sop)).when(kind == 5, "").when(kind == 6, F.col("l_partkey").cast("string"))
        .otherwise(sop)
    )


@query("path_validation", r"""
SELECT page_id, path, errors, CASE WHEN errors <> '' AND path <> '' THEN replace(replace(regexp_replace(path, '[\x00-\x1f\x7f-\x{9f}]', '', 'g'), '../', ''), '..\', '')
         WHEN path <> '' THEN path END AS sanitized,
       CASE WHEN path = '' THEN 'empty' ELSE concat_ws(',', nullif(errors, ''), CASE WHEN length(path) - length(replace(path, '.', '')) > 2 THEN 'multiple_extensions' END) END AS file_name_errors
FROM (SELECT page_id, path, CASE WHEN path = '' THEN 'empty' ELSE concat_ws(',', CASE WHEN length(path) > 4096 THEN 'too_long' END,
        CASE WHEN regexp_matches(path, '[\x00-\x1f\x7f-\x{9f}]') THEN 'control_chars' END, CASE WHEN regexp_matches(path, '\.\./|\.\.\\|^/|^\\') THEN 'path_traversal' END,
        CASE WHEN strpos(path, '//') > 0 THEN 'dangerous_//' WHEN strpos(path, '\\') > 0 THEN 'dangerous_\\' WHEN strpos(path, '..') > 0 THEN 'dangerous_..'
             WHEN strpos(path, '~') > 0 THEN 'dangerous_~' WHEN strpos(path, '$') > 0 THEN 'dangerous_$' END) END AS errors FROM v_path)""")
def path_validation(spark, sf):
    path = F.col("path")
    return X.paths(spark, sf).select(
        "page_id", "path", F.array_join(rules.path_errors(path), ",").alias("errors"),
        rules.sanitized_path(path).alias("sanitized"),
        F.array_join(rules.path_errors(path, is_file_name=True), ",").alias("file_name_errors"),
    )


SCHEMA = [
    rules.TagField("PatientID", "patient_id"),
    rules.TagField("StudyInstanceUID", "study_uid", required=True),
    rules.TagField("SOPClassUID", "sop_class", required=True),
    rules.TagField("Modality", "modality", required=True, transform="uppercase"),
    rules.TagField("StudyTime", "study_time", required=True),
    rules.TagField("Manufacturer", "maker", transform="lowercase"),
]


@query("tag_schema_apply", """
SELECT observation_id, "PatientID" AS patient_id, "StudyInstanceUID" AS study_uid, "SOPClassUID" AS sop_class, upper("Modality") AS modality,
       "StudyTime" AS study_time, lower("Manufacturer") AS maker, "SOPClassUID" IS NOT NULL AND "StudyTime" IS NOT NULL AS success,
       CASE WHEN "SOPClassUID" IS NULL OR "StudyTime" IS NULL THEN 'Missing required tags: ' ||
         concat_ws(', ', CASE WHEN "SOPClassUID" IS NULL THEN 'sop_class' END, CASE WHEN "StudyTime" IS NULL THEN 'study_time' END) END AS error FROM v_tags""")
def tag_schema_apply(spark, sf):
    return rules.tag_schema_apply(with_tags(spark, sf), F.col("tags"), SCHEMA, keep=["observation_id"])


BLOCKS = ["block1", "block2", "block3", "block4", "block5"]


def _match_sql(text: str, patterns) -> str:
    tries = ", ".join(f"nullif(regexp_extract({text}, '{p}', 1), '')" for p in patterns)
    return f"coalesce({tries})"


@query("meas_uid_vendor_a", f"""
SELECT observation_id, CASE WHEN upper(manufacturer) LIKE '%SIEMENS%' AND modality IN ('MR', 'CT', 'XA', 'DX') THEN
  coalesce({", ".join(f"CASE WHEN strpos({b}, 'MeasUID') > 0 THEN {_match_sql(b, V.MEAS_UID_PATTERNS_A)} END" for b in BLOCKS)}) END AS meas_uid FROM v_blocks""")
def meas_uid_vendor_a(spark, sf):
    value = rules.meas_uid_vendor_a(F.col("manufacturer"), F.col("modality"), [F.col(b) for b in BLOCKS])
    return X.vendor_blocks(spark, sf).select("observation_id", value.alias("meas_uid"))


@query("meas_uid_vendor_b", f"""
SELECT observation_id, CASE WHEN upper(manufacturer) = 'UIH' AND modality IN ('MR', 'CT', 'DR', 'CR', 'XR') THEN
  replace(coalesce({", ".join(_match_sql(b, V.MEAS_UID_PATTERNS_B) for b in BLOCKS)}, {_match_sql("series_description", V.SERIES_TEXT_PATTERNS_B)},
    {_match_sql("image_comments", V.MEAS_UID_PATTERNS_B)}), '-', '') END AS meas_uid FROM v_blocks""")
def meas_uid_vendor_b(spark, sf):
    value = rules.meas_uid_vendor_b(
        F.col("manufacturer"), F.col("modality"), [F.col(b) for b in BLOCKS], F.col("series_description"), [F.col("image_comments")]
    )
    return X.vendor_blocks(spark, sf).select("observation_id", value.alias("meas_uid"))


@query("object_class_family", f"""
SELECT sop_class_uid, {FAMILY_SQL} AS family, CASE sop_class_uid WHEN '1.2.840.10008.5.1.4.1.1.2' THEN 'CT' WHEN '1.2.840.10008.5.1.4.1.1.4' THEN 'MR'
  WHEN '1.2.840.10008.5.1.4.1.1.1.1' THEN 'CR/DX' WHEN '1.2.840.10008.5.1.4.1.1.6.1' THEN 'US' ELSE 'PET' END AS exact_family, count(*) AS n
FROM v_obs GROUP BY sop_class_uid""")
def class_family(spark, sf):
    uid = F.col("sop_class_uid")
    return (
        X.observations(spark, sf)
        .select(uid, object_class_family(uid).alias("family"), object_class_family(uid, exact=True).alias("exact_family"))
        .groupBy("sop_class_uid", "family", "exact_family")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _vendor_sql(column: str) -> str:
    whens = " ".join(
        f"WHEN strpos(upper({column}), '{a}') > 0 THEN '{name}'" for name, aliases in V.VENDOR_ALIASES.items() for a in aliases
    )
    return f"CASE WHEN coalesce({column}, '') = '' THEN 'GENERIC' {whens} ELSE substr(upper({column}), 1, 32) END"


@query("vendor_normalize", f'SELECT observation_id, "Manufacturer" AS manufacturer, {_vendor_sql(chr(34) + "Manufacturer" + chr(34))} AS vendor FROM v_tags')
def vendor_normalize(spark, sf):
    maker = F.col("Manufacturer")
    return X.tags(spark, sf).select("observation_id", maker.alias("manufacturer"), rules.vendor_normalize(maker).alias("vendor"))


# --- private tags and sensitive fields ---------------------------------------------------

POLICY = T.PrivateTagPolicy(
    redact=("src0", "src1"), interpret=("src1", "src2", "src3", "src4", "src5", "src6"), preserve=("src2", "src9")
)

RAW = "CASE WHEN action <> 'redact' THEN encode(raw_text) END"
TEXT = f"regexp_replace(raw_text, '^{V.WHITESPACE}+|{V.WHITESPACE}+$', '', 'g')"
PRIVATE = {
    "v_policy": f"""SELECT observation_id, creator, tag, vr, {RAW} AS raw_value,
          CASE WHEN action = 'interpret' AND vr IN ('LO', 'UT') AND {TEXT} <> '' THEN {TEXT} END AS interpreted_value,
          CASE WHEN action = 'redact' THEN 'redacted' WHEN action = 'interpret' AND vr IN ('LO', 'UT') AND {TEXT} <> '' THEN 'interpreted' ELSE 'preserved' END AS redaction_status,
          CASE WHEN action = 'redact' THEN 'policy: ' || creator || ' in redact list' END AS redaction_reason
        FROM (SELECT *, CASE WHEN creator IN ('src0', 'src1') THEN 'redact' WHEN creator IN ('src2', 'src3', 'src4', 'src5', 'src6') THEN 'interpret' ELSE 'preserve' END AS action FROM v_ptag)""",
    "v_request": """SELECT 'obs' || c_custkey AS observation_id, CASE WHEN c_nationkey % 3 > 0 THEN 'src' || (c_nationkey % 20) END AS creator, c_mktsegment AS reason FROM customer""",
    "v_redacted": """SELECT p.observation_id, p.creator, tag, vr, CASE WHEN r.reason IS NULL THEN raw_value END AS raw_value,
          CASE WHEN r.reason IS NULL THEN interpreted_value END AS interpreted_value, CASE WHEN r.reason IS NULL THEN redaction_status ELSE 'redacted' END AS redaction_status,
          coalesce(r.reason, redaction_reason) AS redaction_reason
        FROM v_policy p LEFT JOIN v_request r ON r.observation_id = p.observation_id AND (r.creator IS NULL OR r.creator = p.creator)""",
}
SHOWN = "observation_id, creator, tag, vr, md5(raw_value) AS raw_md5, CAST(octet_length(raw_value) AS BIGINT) AS raw_bytes, md5(interpreted_value) AS text_md5, redaction_status, redaction_reason"


def shown(tags):
    return tags.select(
        "observation_id", "creator", "tag", "vr", F.md5("raw_value").alias("raw_md5"),
        F.octet_length("raw_value").cast("bigint").alias("raw_bytes"), F.md5("interpreted_value").alias("text_md5"),
        "redaction_status", "redaction_reason",
    )


def stored_tags(spark, sf):
    return T.apply_policy(X.private_tags(spark, sf), POLICY)


def redacted_tags(spark, sf):
    nation = F.col("c_nationkey")
    requests = X.table(spark, sf, "customer").select(
        F.concat(F.lit("obs"), F.col("c_custkey").cast("string")).alias("observation_id"),
        F.when(nation % 3 > 0, F.concat(F.lit("src"), (nation % 20).cast("string"))).alias("creator"),
        F.col("c_mktsegment").alias("reason"),
    )
    return T.redact(stored_tags(spark, sf), requests)


@query("private_tag_policy", f"SELECT {SHOWN} FROM v_policy", PRIVATE)
def private_tag_policy(spark, sf):
    return shown(stored_tags(spark, sf))


@query("private_tag_redact", f"SELECT {SHOWN} FROM v_redacted", PRIVATE)
def private_tag_redact(spark, sf):
    return shown(redacted_tags(spark, sf))


@query("private_tag_read", f"SELECT {SHOWN} FROM v_redacted WHERE redaction_status <> 'redacted'", PRIVATE)
def private_tag_read(spark, sf):
    return shown(T.readable(redacted_tags(spark, sf)))


@query("private_tag_summary", """
SELECT observation_id, creator, count(*) AS total_tags, count(*) FILTER (WHERE redaction_status = 'redacted') AS redacted_count,
       count(*) FILTER (WHERE redaction_status = 'interpreted') AS interpreted_count FROM v_redacted GROUP BY ALL""", PRIVATE)
def private_tag_summary(spark, sf):
    return T.summary(redacted_tags(spark, sf))


@query("phi_redact", """
SELECT doc_id, '[REDACTED-PHI]' AS patient_name, source AS modality, '[REDACTED-PHI]' AS inner_id, lang AS inner_note, '[REDACTED-PHI]' AS list_operator, doc_id AS list_number,
       '[REDACTED-PHI]' AS map_birth_date, lang AS map_other FROM documents""")
def phi_redact(spark, sf):
    shaped = X.table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("Patient_Name"),
        F.col("source").alias("modality"),
        F.struct(F.col("source").alias("patient_ID"), F.col("lang").alias("note")).alias("inner"),
        F.array(F.struct(F.col("lang").alias("operator_name"), F.col("doc_id").alias("number"))).alias("listed"),
        F.create_map(F.lit("PATIENT_BIRTH_DATE"), F.col("source"), F.lit("other"), F.col("lang")).alias("extra"),
    )
    return privacy.redact_fields(shaped).select(
        "doc_id", F.col("Patient_Name").alias("patient_name"), "modality",
        F.col("inner.patient_ID").alias("inner_id"), F.col("inner.note").alias("inner_note"),
        F.col("listed")[0]["operator_name"].alias("list_operator"), F.col("listed")[0]["number"].alias("list_number"),
        F.col("extra")["PATIENT_BIRTH_DATE"].alias("map_birth_date"), F.col("extra")["other"].alias("map_other"),
    )


@query("safe_int", """
SELECT observation_id, instance_number, TRY_CAST(instance_number AS INTEGER) AS number,
       TRY_CAST(CASE WHEN l_partkey % 3 = 0 THEN ' 12 ' WHEN l_partkey % 3 = 1 THEN '99999999999' ELSE '' END AS INTEGER) AS other FROM v_obs""")
def safe_int(spark, sf):
    kind = F.col("l_partkey") % 3
    other = F.when(kind == 0, " 12 ").when(kind == 1, "99999999999").otherwise("")
    return X.observations(spark, sf).select(
        "observation_id", "instance_number", rules.safe_int(F.col("instance_number")).alias("number"), rules.safe_int(other).alias("other")
    )


JSON_TAGS = sorted([*X.TAG_SQL, "AcquisitionDate", "IconImage"])


def _json_sql(names) -> str:
    """Members of the tags that are there, as text, in order of their names."""
    members = [f"CASE WHEN \"{n}\" IS NOT NULL THEN '\"{n}\":' || CAST(to_json(\"{n}\") AS VARCHAR) END" for n in names]
    return f"concat_ws(',', {', '.join(members)})"


@query("tag_json_serialise", f"""
SELECT observation_id, CASE WHEN body <> '' THEN '{{' || body || '}}' END AS tag_json
FROM (SELECT observation_id, {_json_sql(JSON_TAGS)} AS body
      FROM (SELECT t.*, CAST(observed_at AS VARCHAR) AS "AcquisitionDate", CASE WHEN l_partkey % 2 = 0 THEN 'A' || chr(65533) || v_obs.modality END AS "IconImage"
            FROM v_tags t JOIN v_obs USING (observation_id)))""")
def tag_json_serialise(spark, sf):
    """All tags, one of them bytes that are no valid text, one a date."""
    obs = X.observations(spark, sf).select("observation_id", "observed_at", "l_partkey", "modality")
    icon = F.concat(F.lit(bytearray(b"A\xff")), F.col("modality").cast("binary"))
    raw = F.when(F.col("l_partkey") % 2 == 0, F.create_map(F.lit("IconImage"), icon))
    dates = F.create_map(F.lit("AcquisitionDate"), F.col("observed_at"))
    return with_tags(spark, sf).join(obs, "observation_id").select("observation_id", rules.tag_json(F.col("tags"), raw, dates).alias("tag_json"))


@query("header_uid_validation", """
SELECT observation_id, concat_ws('; ', CASE WHEN bad THEN 'Invalid UID format in SOPInstanceUID: ' || uid END, CASE WHEN l_partkey % 5 = 0 THEN 'Invalid UID format in FrameOfReferenceUID: ' || 'frame' END) AS errors
FROM (SELECT *, uid <> '' AND NOT regexp_matches(uid, '^[0-9]+(\\.[0-9]+)+$') AS bad FROM v_uid JOIN v_obs USING (observation_id))""", UIDS)
def header_uid_validation(spark, sf):
    tags = F.create_map(
        F.lit("SOPInstanceUID"), broken_uid(), F.lit("StudyInstanceUID"), F.col("study_instance_uid"),
        F.lit("FrameOfReferenceUID"), F.when(F.col("l_partkey") % 5 == 0, "frame"),
    )
    return X.observations(spark, sf).select("observation_id", F.array_join(rules.header_uid_errors(tags), "; ").alias("errors"))


# --- paths -------------------------------------------------------------------------------


@query("object_key", """
SELECT item_id, 'dicom/' || substr(whole_file_sha256, 1, 2) || '/' || substr(whole_file_sha256, 3) || '/' || item_id || '.dcm' AS object_key,
       error_detail AS meta_detail, coalesce(length(error_detail) > 1024, false) AS meta_too_long FROM v_item""")
def object_key(spark, sf):
    detail = F.create_map(F.lit("detail"), F.col("error_detail"))
    meta = H.object_metadata(detail)
    return X.items(spark, sf).select(
        "item_id", H.object_key(F.col("whole_file_sha256"), F.when(F.col("item_id") % 2 == 0, F.col("source_path"))
                                .otherwise(F.regexp_replace("source_path", r"\.dcm$", ""))).alias("object_key"),
        meta["x-amz-meta-detail"].alias("meta_detail"),
        H.metadata_too_long(detail).alias("meta_too_long"),
    )


def _tail_sql(uid: str) -> str:
    return f"coalesce(substr(array_to_string(string_split(nullif({uid}, ''), '.')[-2:], '.'), 1, 32), 'UNKNOWN')"


PATH = {
    "v_archive": f"""SELECT observation_id, CASE WHEN coalesce("SOPInstanceUID", '') = '' THEN 'DICOM_UNKNOWN/GENERIC/GENERIC/' ||
            CASE WHEN length(safe) > 64 THEN 'file_' || substr(sha256(safe), 1, 16) || '.dcm' ELSE safe END
          ELSE 'DICOM_' || upper("Modality") || '/' || substr(regexp_replace({_vendor_sql(chr(34) + "Manufacturer" + chr(34))}, '[^A-Za-z0-9_-]', '_', 'g'), 1, 16) || '/'
            || coalesce(substr(regexp_replace("ManufacturerModelName", '[^A-Za-z0-9_-]', '_', 'g'), 1, 48), 'GENERIC') || '/' || {_tail_sql('"StudyInstanceUID"')} || '/'
            || coalesce(meas, {_tail_sql('"SeriesInstanceUID"')}) || '/' || {_tail_sql('"SeriesInstanceUID"')} || '/' || "SOPInstanceUID" || '.dcm' END AS path
        FROM (SELECT *, regexp_replace("PatientName" || ' ' || observation_id || ' ' || coalesce("PatientID", repeat('x', 30)), '[^A-Za-z0-9._-]', '_', 'g') AS safe,
                CASE WHEN "StudyTime" IS NOT NULL THEN 'm_' || substr(observation_id, 1, 40) END AS meas FROM v_tags)""",
}


def archive_paths(spark, sf):
    tags = X.tags(spark, sf).withColumn(
        "meas_uid", F.when(F.col("StudyTime").isNotNull(), F.concat(F.lit("m "), F.substring("observation_id", 1, 40)))
    )
    names = ["Modality", "Manufacturer", "ManufacturerModelName", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "meas_uid"]
    original = F.concat_ws(" ", "PatientName", "observation_id", F.coalesce("PatientID", F.repeat(F.lit("x"), 30)))
    headers = tags.select("observation_id", X.tag_map(tags, names).alias("tags"), original.alias("original"))
    return H.archive_path(headers, "tags", "original").select("observation_id", "path")


@query("archive_path", "SELECT observation_id, path FROM v_archive", PATH)
def archive_path(spark, sf):
    return archive_paths(spark, sf)


SHORT_MAX, SHORT_BASE = 78, "/srv/a"
BUDGET = SHORT_MAX - len(SHORT_BASE) - 1


def _abbreviate(p: str) -> str:
    return "CASE " + " ".join(f"WHEN strpos(upper({p}), '{n}') > 0 THEN '{a}'" for n, a in V.VENDOR_SHORT.items()) + f" ELSE {p} END"


SHORT = {
    **PATH,
    "v_s1": """SELECT observation_id, path, string_split(path, '/') AS p0, CASE WHEN len(string_split(path, '/')) < 4 THEN string_split(path, '/') ELSE
        string_split(path, '/')[1:1] || list_transform(string_split(path, '/')[2:], lambda p: CASE WHEN length(p) > 20 AND len(string_split(p, '.')) >= 4 THEN
          substr(array_to_string(string_split(p, '.')[1:2], '.') || '_H_' || substr(sha256(p), 1, 8) || '_H_' || array_to_string(string_split(p, '.')[-2:], '.'), 1, 48) ELSE p END) END AS p1 FROM v_archive""",
    "v_s2": """SELECT *, CASE WHEN d IS NULL THEN p1 ELSE p1[1:d - 1] || ['DEV_' || substr(sha256(p1[d]), 1, 8)] || p1[d + 1:] END AS p2
        FROM (SELECT *, list_min(list_filter(range(2, len(p1) - 1), lambda i: length(p1[i]) > 32)) AS d FROM v_s1)""",
    "v_s3": f"SELECT *, list_transform(p2, lambda p: {_abbreviate('p')}) AS p3 FROM v_s2",
    "v_s4": "SELECT *, CASE WHEN len(p3) >= 4 THEN p3[1:2] || ['CONT_' || substr(sha256(array_to_string(p3[3:], '/')), 1, 16)] ELSE p3 END AS p4 FROM v_s3",
}


@query("path_shorten", f"""
SELECT observation_id, path, CASE {" ".join(f"WHEN length(array_to_string(p{i}, '/')) <= {BUDGET} THEN array_to_string(p{i}, '/')" for i in range(5))}
  ELSE 'OVERFLOW/' || (length(path) + {len(SHORT_BASE) + 1}) || '_' || substr(sha256(array_to_string(p4, '/')), 1, 24) END AS short_path FROM v_s4""", SHORT)
def path_shorten(spark, sf):
    return H.path_shorten(archive_paths(spark, sf), "path", SHORT_BASE, SHORT_MAX)


@query("path_version", """
SELECT observation_id, path, sha, CASE WHEN sha = base THEN path ELSE regexp_replace(path, '\\.dcm$', '') || '_v' ||
  lpad(CAST(row_number() OVER (PARTITION BY path, sha = base ORDER BY observed_at, observation_id) AS VARCHAR), 3, '0') || '.dcm' END AS stored_path
FROM (SELECT *, first_value(sha) OVER (PARTITION BY path ORDER BY observed_at, observation_id) AS base
      FROM (SELECT observation_id, observed_at, whole_file_sha256 AS sha, modality || '/' || split_part(sop_instance_uid, '.', 4) || '.dcm' AS path FROM v_obs))""")
def path_version(spark, sf):
    files = X.observations(spark, sf).select(
        "observation_id", "observed_at", F.col("whole_file_sha256").alias("sha"),
        F.concat("modality", F.lit("/"), F.element_at(F.split("sop_instance_uid", r"\."), 4), F.lit(".dcm")).alias("path"),
    )
    return H.path_version(staged(files, "files")).select("observation_id", "path", "sha", "stored_path")
