"""Manifests as JSON text: every kind of error, labels, matches."""

from __future__ import annotations

import json

from obsledger.sources.manifest_json import curated_items, read_manifests

FILES = [
    "/m/p/data/s1.dcm", "/m/p/data/s2/a.dcm", "/m/p/data/s2/b/c.dcm", "/m/p/data/s3.dcm", "/m/p/masks/s1.json", "/m/p/masks/s1/x.png", "/m/p/masks/s2/x.png",
    "/m/p/boxes/s3", "/m/p/single.txt", "/m/q/data/s1.dcm", "/m/q/data/s1/a.dcm", "/m/q/data/.hidden", "/other/masks/s1.json", "/other/data/s1.dcm",
]


def run(spark, *contents, folder="/m/p"):
    listing = spark.createDataFrame([(f, len(f)) for f in FILES], "path string, byte_size bigint")
    rows = [(f"{folder}/{i}.json", c if c is None or isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)]
    manifests = read_manifests(spark.createDataFrame(rows, "manifest_path string, content string"), listing, ["/m/", "/n"])
    items, errors = curated_items(manifests, listing)
    return items.collect(), sorted(tuple(r) for r in errors.collect()), manifests


FAILING = [
    (None, "CuratedManifestUnreadable", "manifest unreadable"),
    ("{oops", "CuratedManifestInvalidJson", "manifest is not valid JSON"),
    ("", "CuratedManifestInvalidJson", "manifest is not valid JSON"),
    ([1], "CuratedManifestInvalidJson", "manifest root must be an object"),
    ("null", "CuratedManifestInvalidJson", "manifest root must be an object"),
    ({}, "CuratedManifestMissingDataPath", "manifest missing data path"),
    ({"data": None}, "CuratedManifestMissingDataPath", "manifest missing data path"),
    ({"data": 5}, "CuratedManifestMissingDataPath", "manifest data path is empty"),
    ({"data": " \t"}, "CuratedManifestMissingDataPath", "manifest data path is empty"),
    ({"data": {"path": None}}, "CuratedManifestMissingDataPath", "manifest data path is empty"),
    ({"data": "/other/data"}, "CuratedManifestDataPathOutsideAllowedRoot", "path outside allowed roots"),
    ({"data": "../../mm/data"}, "CuratedManifestDataPathOutsideAllowedRoot", "path outside allowed roots"),
    ({"data": "nothing"}, "CuratedManifestDataPathInvalid", "path does not exist"),
    ({"data": "single.txt"}, "CuratedManifestDataPathInvalid", "path is not a directory"),
]


def test_manifests_that_fail(spark):
    items, errors, _ = run(spark, *[f[0] for f in FAILING])
    assert items == [] and errors == sorted((f"/m/p/{i}.json", f"{i}.json", *f[1:]) for i, f in enumerate(FAILING))


def test_entries_that_fail(spark):
    entries = [7, {}, {"path": ""}, {"path": 3}, {"path": "/other/masks", "required": 1, "name": "far"}, {"path": "gone/", "required": True}, {"path": "gone2", "required": False}]
    items, errors, _ = run(spark, {"data": {"path": "./data"}, "annotation": entries})
    assert [e[1:] for e in errors] == [
        ("/other/masks", "AnnotationPathOutsideAllowedRoot", "path outside allowed roots"),
        ("0.json", "CuratedManifestInvalidJson", "annotation[0] must be an object"),
        ("0.json", "CuratedManifestInvalidJson", "annotation[1] missing path"),
        ("0.json", "CuratedManifestInvalidJson", "annotation[2] missing path"),
        ("0.json", "CuratedManifestInvalidJson", "annotation[3] missing path"),
        ("gone/", "AnnotationPathMissing", "annotation path does not exist"),
        ("gone2", "AnnotationPathMissing", "annotation path does not exist"),
    ]
    assert len(items) == 4 and all(r["missing"] == ["far", "gone"] and r["annotations"] == [] for r in items)


def test_annotation_that_is_no_list(spark):
    values = [{"path": "masks"}, "x", True, {}, "", 0, None, []]
    items, errors, _ = run(spark, *[{"data": "data", "annotation": v} for v in values])
    assert len(items) == 4 * len(values)
    assert errors == [(f"/m/p/{i}.json", f"{i}.json", "CuratedManifestInvalidJson", "annotation must be a list") for i in range(3)]


def test_labels_and_matches(spark):
    entries = [
        {"path": "masks", "name": "mask", "required": "false", "task_type": " segmentation "},
        {"path": "boxes/", "name": "", "label_name": "box", "task_type": 5},
        {"path": "/m/p/../p/masks", "name": 8, "required": [0]},
        {"path": "single.txt", "label_name": "", "required": 0},
        {"path": "gone", "name": "mask", "required": True},
    ]
    items, errors, manifests = run(spark, {"data": "data", "annotation": entries}, {"data": "data"})
    specs = {r["spec_no"]: r for r in manifests.specs.collect()}
    assert [specs[i]["label"] for i in range(4)] == ["mask", "box", "masks", "single.txt"]
    assert [specs[i]["required"] for i in range(4)] == [True, False, True, False]
    assert [specs[i]["task_type"] for i in range(4)] == ["segmentation", None, None, None]
    assert specs[2]["source_path"] == "masks"
    by_path = {r["relative_path"]: r for r in items if r["manifest_path"] == "/m/p/0.json"}
    assert sorted(by_path) == ["data/s1.dcm", "data/s2/a.dcm", "data/s2/b/c.dcm", "data/s3.dcm"]
    assert [(a["spec_no"], a["path"]) for a in by_path["data/s1.dcm"]["annotations"]] == [(0, "masks/s1.json"), (2, "masks/s1.json")]
    assert [(a["spec_no"], a["path"]) for a in by_path["data/s2/b/c.dcm"]["annotations"]] == [(0, "masks/s2"), (2, "masks/s2")]
    assert [(a["spec_no"], a["path"]) for a in by_path["data/s3.dcm"]["annotations"]] == [(1, "boxes/s3")]
    assert by_path["data/s1.dcm"]["missing"] == ["mask"] and by_path["data/s3.dcm"]["missing"] == ["mask", "masks"]
    plain = [r for r in items if r["manifest_path"] == "/m/p/1.json"]
    assert len(plain) == 4 and all(r["missing"] == [] and r["annotations"] == [] for r in plain)


def test_repeated_samples(spark):
    items, errors, _ = run(spark, {"data": "data"}, folder="/m/q")
    assert [r["sample_id"] for r in items] == [".hidden"]
    assert [(e[1], e[2], e[3]) for e in errors] == [("data/s1.dcm", "DuplicateCuratedSampleId", "s1"), ("data/s1/a.dcm", "DuplicateCuratedSampleId", "s1")]
