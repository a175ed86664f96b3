"""Rules over hand-made rows, the cases the given tables do not hold."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from obsledger.functions import paths as H
from obsledger.functions import privacy, rules
from obsledger.functions import values as V
from obsledger.functions.keys import item_fingerprint, natural_key
from obsledger.functions.text import sanitize_detail, sanitize_path, strip
from obsledger.operators import private_tags as T
from obsledger.operators import references as R
from obsledger.operators.canonical import object_class_family
from tests.conftest import rows


def one(spark, values, expression):
    """`expression` over a column `x` of the given strings."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_normalized_path(spark):
    given = ["a/b", "a//b/./c", "a/../b", "../a", "a/../../b", "/../etc", "/a/../..", "", "a/..", "../../x/.."]
    assert one(spark, given, rules.normalized_path) == [
        "a/b", "a/b/c", "b", "../a", "../b", "/etc", "/", ".", ".", "../..",
    ]


def test_path_errors(spark):
    given = ["ok/x.dcm", "", None, "a" * 4097, "x\0y", "a/../b", "/abs", "c:\\d", "a\\\\b", "~x", "cost$", "a.b.c.d"]
    assert one(spark, given, rules.path_errors) == [
        [], ["empty"], ["empty"], ["too_long"], ["null_byte", "control_chars"], ["path_traversal", "dangerous_.."],
        ["path_traversal"], [], ["dangerous_\\\\"], ["dangerous_~"], ["dangerous_$"], [],
    ]
    assert one(spark, ["a.b.c.d"], lambda c: rules.path_errors(c, is_file_name=True)) == [["multiple_extensions"]]


def test_sanitized_path(spark):
    assert one(spark, ["ok", "a/../b", "x\x07y\0z", "..\\c", ""], rules.sanitized_path) == ["ok", "a/b", "xyz", "c", None]


def test_uid_errors(spark):
    given = ["1.2.3", "1", "", "1..2", ".1", "1.", "1.a", "1." * 40 + "1"]
    assert one(spark, given, rules.uid_errors) == [
        [], [], ["empty"], ["invalid_characters", "consecutive_dots"], ["invalid_characters", "starts_with_dot"],
        ["invalid_characters", "ends_with_dot"], ["invalid_characters"], ["too_long"],
    ]
    assert one(spark, given[:3], rules.is_dotted_number) == [True, False, False]


def test_object_class_family_orders(spark):
    root = "1.2.840.10008.5.1.4.1.1."
    given = [root + n for n in ("2", "4", "1.1", "6.1", "7", "128", "481.3", "88.11", "20", "66.4")] + ["1.2", "", None]
    assert one(spark, given, object_class_family) == [
        "CT", "MR", "CR/DX", "US", "SC", "CR/DX", "MR", "SR", "CT", "US", "OTHER", None, None,
    ]
    assert one(spark, given[:10], lambda c: object_class_family(c, exact=True)) == [
        "CT", "MR", "CR/DX", "US", "SC", "PET", "RT", "SR", "OTHER", "OTHER",
    ]


def test_vendor_normalize(spark):
    given = ["Siemens AG", "general electric", "联影医疗", "Toshiba", "fuji", "acme", "", None, "x" * 40]
    assert one(spark, given, rules.vendor_normalize) == [
        "SIEMENS", "GE", "UIH", "CANON", "FUJIFILM", "ACME", "GENERIC", "GENERIC", "X" * 32,
    ]


def test_safe_int(spark):
    assert one(spark, ["7", " 12 ", "-3", "n/a", "", "1.5", None], rules.safe_int) == [7, 12, -3, None, None, None, None]


def test_measurement_ids(spark):
    columns = "m string, mod string, a string, b string, d string, c string"
    df = spark.createDataFrame(
        [
            ("SIEMENS", "MR", None, "x MeasUID=0123456789abcdef y", None, None),
            ("SIEMENS", "US", "MeasUID: 0123456789", None, None, None),
            ("SIEMENS", "CT", "nothing", None, None, None),
            ("SIEMENS", "CT", 'q "MeasUID": "ab-1" z', "MeasUID: 99999999", None, None),
            ("United Imaging", "MR", None, None, "Meas-UID: aaaa-bbbb-cc", None),
            ("联影", "CT", None, None, "测量ID=12345678", "MeasUID 0123456789abcdef0"),
            ("UIH", "CT", None, None, None, "see measuid=01234567-8"),
        ],
        columns,
    )
    blocks = [F.col("a"), F.col("b")]
    a = rules.meas_uid_vendor_a(F.col("m"), F.col("mod"), blocks)
    b = rules.meas_uid_vendor_b(F.col("m"), F.col("mod"), blocks, F.col("d"), [F.col("c")])
    assert [tuple(r) for r in df.select(a, b).collect()] == [
        ("0123456789abcdef", None), (None, None), (None, None), ("ab-1", None), (None, "aaaabbbbcc"), (None, "12345678"),
        (None, "012345678"),
    ]


def test_tag_rules(spark):
    df = spark.createDataFrame(
        [
            ({"SOPInstanceUID": "1", "SOPClassUID": "2", "StudyInstanceUID": "3", "SeriesInstanceUID": "4", "Note": "n"},),
            ({"SOPInstanceUID": "", "StudyInstanceUID": "3"},),
        ],
        "t map<string,string>",
    )
    t = F.col("t")
    got = df.select(
        rules.missing_of(t, V.MANDATORY_TAGS), rules.tag_validation(t), rules.tag_validation(t, strict=True),
        F.size(rules.identity_tags(t)), rules.has_pixels(t),
    ).collect()
    assert [tuple(r) for r in got] == [
        ([], "valid", "incomplete", 4, False),
        (["SOPInstanceUID", "SOPClassUID", "SeriesInstanceUID"], "invalid", "invalid", 1, False),
    ]
    schema = [rules.TagField("StudyInstanceUID", "study", True), rules.TagField("Note", "note", True, "uppercase")]
    assert rows(rules.tag_schema_apply(df, t, schema)) == [
        ("3", "N", True, None), ("3", None, False, "Missing required tags: note"),
    ]


def test_tag_json_is_null_without_tags(spark):
    df = spark.createDataFrame([({"a": "x/y"},), ({},), (None,)], "t map<string,string>")
    got = [r[0] for r in df.select(rules.tag_json(F.col("t"))).collect()]
    assert json.loads(got[0]) == {"a": "x/y"}
    assert got[1:] == [None, None]


def test_report_texts(spark):
    assert one(spark, ["/srv/a/b.dcm", "rel/b.dcm", None], sanitize_path) == ["b.dcm", "rel/b.dcm", ""]
    given = ["cannot read: /srv/x: y", "size: 12: /etc", "plain", None, "a:/b"]
    assert one(spark, given, sanitize_detail) == ["cannot read", "size: 12: /etc", "plain", "", "a:/b"]
    assert one(spark, ["\t a b\u3000\n"], strip) == ["a b"]


def test_keys_take_null_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(natural_key("x", "y")).collect()]
    assert keys[0] == keys[1] != keys[2]
    prints = df.select(item_fingerprint(F.col("x"), F.col("y"), F.lit("p"), F.lit(1))).distinct().count()
    assert prints == 2


def test_item_fingerprint_is_over_job_kind_path_size(spark):
    import hashlib

    df = spark.createDataFrame([(7, "local_folder", "a/b.dcm", 12)], "j int, k string, p string, n long")
    got = df.select(item_fingerprint(F.col("j"), F.col("k"), F.col("p"), F.col("n"))).first()[0]
    assert got == hashlib.sha256(b"7:local_folder:a/b.dcm:12").hexdigest()


def test_tag_json_takes_bytes_and_dates(spark):
    import datetime
    import json

    df = spark.createDataFrame([({"b": 'x"y'}, {"a": bytearray(b"A\xffB")}, {"c": datetime.date(2024, 1, 2)}), ({}, None, None)], "t map<string,string>, r map<string,binary>, d map<string,date>")
    got = [r[0] for r in df.select(rules.tag_json(F.col("t"), F.col("r"), F.col("d"))).collect()]
    assert json.loads(got[0]) == {"a": "A\ufffdB", "b": 'x"y', "c": "2024-01-02"} and got[1] is None


def test_private_values_are_whole_by_default(spark):
    tags = spark.createDataFrame([("o", "c", "0009", "UN", bytearray(b"x" * 100_000))], "observation_id string, creator string, tag string, vr string, raw_value binary")
    assert len(T.apply_policy(tags, T.PrivateTagPolicy()).first()["raw_value"]) == 100_000


def test_redaction_reaches_every_depth(spark):
    df = spark.createDataFrame(
        [("Ann", [{"Operator_Name": "Bob", "n": "1"}], {"PATIENT_SEX": "F", "k": "v"}, (("Eve",),))],
        "Patient_Name string, parts array<map<string,string>>, extra map<string,string>, deep struct<inner:struct<patient_id:string>>",
    )
    row = privacy.redact_fields(df).collect()[0].asDict(recursive=True)
    assert row == {
        "Patient_Name": V.REDACTED, "parts": [{"Operator_Name": V.REDACTED, "n": "1"}],
        "extra": {"PATIENT_SEX": V.REDACTED, "k": "v"}, "deep": {"inner": {"patient_id": V.REDACTED}},
    }


def test_private_tag_policy_limits_and_bad_bytes(spark):
    df = spark.createDataFrame(
        [
            ("o", "keep", "(0029,1001)", "OB", bytearray(b"x" * 20)),
            ("o", "read", "(0029,1002)", "LO", bytearray(b" ok\xff ")),
            ("o", "read", "(0029,1003)", "OB", bytearray(b"bytes")),
            ("o", "gone", "(0029,1004)", "LO", bytearray(b"secret")),
            ("o", None, "(0029,1005)", "LO", None),
        ],
        "observation_id string, creator string, tag string, vr string, raw_value binary",
    )
    policy = T.PrivateTagPolicy(redact=["gone"], interpret=["read", "gone"], max_raw_value=4)
    got = T.apply_policy(df, policy).select("raw_value", "interpreted_value", "redaction_status", "redaction_reason").collect()
    assert [tuple(r) for r in got] == [
        (bytearray(b"xxxx<truncated>"), None, "preserved", None),
        (bytearray(b" ok\xff "), "ok\ufffd", "interpreted", None),
        (bytearray(b"bytes"), None, "preserved", None),
        (None, None, "redacted", "policy: gone in redact list"),
        (None, None, "preserved", None),
    ]


def test_magic_bytes(spark):
    good = b"\0" * 128 + b"DICM"
    df = spark.createDataFrame([(bytearray(good),), (bytearray(good[:-1]),), (bytearray(b"DICM" * 40),), (bytearray(b""),)], "c binary")
    assert [r[0] for r in df.select(rules.looks_like_image(F.col("c"))).collect()] == [True, False, True, False]


def test_archive_path_rules(spark):
    df = spark.createDataFrame(
        [
            ({"modality": "mr", "vendor": "SIEMENS", "device_model": "Pri sma", "study_uid": "1.2.3.45", "series_uid": "1.2.9",
              "sop_instance_uid": "1.2..3/x", "meas_uid": "m 1"}, "f.dcm"),
            ({"Modality": "CT", "SOPInstanceUID": "9"}, "f.dcm"),
            ({"Modality": "CT"}, "näme 1.dcm"),
            ({}, "x" * 70),
        ],
        "t map<string,string>, name string",
    )
    got = [r["path"] for r in H.archive_path(df, "t", "name").collect()]
    assert got[:3] == [
        "DICOM_MR/SIEMENS/Pri_sma/3.45/m_1/2.9/1.2_3_x.dcm",
        "DICOM_CT/GENERIC/GENERIC/UNKNOWN/UNKNOWN/UNKNOWN/9.dcm",
        "DICOM_UNKNOWN/GENERIC/GENERIC/n_me_1.dcm",
    ]
    assert got[3].startswith("DICOM_UNKNOWN/GENERIC/GENERIC/file_") and len(got[3]) == len("DICOM_UNKNOWN/GENERIC/GENERIC/file_.dcm") + 16


def test_path_shorten_takes_the_mildest_step(spark):
    uid = "1.2.840.113619.2.123.456.789"
    long_path = f"DICOM_MR/SIEMENS/{'d' * 40}/{uid}/{uid}/{uid}/{uid}.dcm"
    df = spark.createDataFrame([("a/b.dcm",), (long_path,)], "p string")
    for limit in (60, 75, 110, 180, 240):
        for row in H.path_shorten(df, "p", "/srv", limit).collect():
            assert len("/srv/" + row["short_path"]) <= limit
            if len("/srv/" + row["p"]) <= limit:
                assert row["short_path"] == row["p"]
    tight = H.path_shorten(df, "p", "/srv", 30).collect()[1]["short_path"]
    assert tight.startswith("OVERFLOW/") and len("/srv/" + tight) <= 30
    with pytest.raises(ValueError):
        H.path_shorten(df, "p", "/a/very/long/base/folder", 40)


def test_path_version_numbers(spark):
    df = spark.range(1200).select(
        F.lit("in/x.tar.dcm").alias("path"),
        F.when(F.col("id").isin(0, 5), "base").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("sha"),
        F.lit("2024-01-01").cast("date").alias("observed_at"), F.format_string("%05d", "id").alias("observation_id"),
    )
    got = {r["observation_id"]: r["stored_path"] for r in H.path_version(df).collect()}
    assert got["00000"] == got["00005"] == "in/x.tar.dcm"
    assert got["00001"] == "in/x.tar_v001.dcm"
    assert got["00006"] == "in/x.tar_v005.dcm"
    assert got["01199"] == "in/x.tar_v1198.dcm"


def test_references_from_header_json(spark):
    headers = [
        {"ReferencedImageSequence": [{"ReferencedSOPInstanceUID": "i1", "ReferencedFrameNumber": 2}, {"x": 1}]},
        {"SourceInstanceSequence": {"ReferencedSeriesInstanceUID": "s1", "ReferencedFrameNumber": "no"}},
        {"ReferencedSOPClassUID": "c", "ReferencedSOPInstanceUID": "i2"},
        {"ReferencedSOPInstanceUID": "lonely"},
        {"ReferencedStudySequence": []},
        {"ReferencedImageSequence": "text"},
    ]
    df = spark.createDataFrame([(str(i), json.dumps(h)) for i, h in enumerate(headers)], "from_sop string, raw_tags string")
    assert rows(R.refs_extract(df)) == [
        ("0", "referenced_image", None, None, "i1", 2),
        ("1", "source_instance", None, "s1", None, None),
        ("2", "referenced_instance", None, None, "i2", None),
    ]


def test_edges_upsert_is_null_safe_and_newest_wins(spark):
    columns = "from_sop string, relationship string, to_study string, to_series string, to_sop string, frame_number int, status string, resolved_sop string"
    old = spark.createDataFrame([("a", "x", None, None, "i", None, "unresolved", None), ("b", "x", None, "s", None, 1, "resolved", "k")], columns)
    new = spark.createDataFrame([("a", "x", "", None, "i", 0, "resolved", "i"), ("c", "x", None, "s", None, None, "unresolved", None)], columns)
    got = R.edges_upsert(old, new.unionByName(new))
    assert rows(got, "from_sop", "status", "resolved_sop") == [("a", "resolved", "i"), ("b", "resolved", "k"), ("c", "unresolved", None)]
