"""Files, manifests and written tables on temporary folders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.sources import files, manifests, store
from tests.conftest import rows


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub" / "deep").mkdir(parents=True)
    (root / "a.dcm").write_bytes(b"\0" * 128 + b"DICM" + b"x")
    (root / "b.txt").write_bytes(b"plain")
    (root / "sub" / "c.dcm").write_bytes(b"\0" * 500)
    (root / "sub" / "deep" / "d.dcm").write_bytes(b"\0" * 128 + b"DICM")
    return str(root)


@pytest.fixture
def inventory(spark):
    sizes = {"/in/a.dcm": 133, "/in/b.txt": 5, "/in/sub/c.dcm": 500, "/in/sub/deep/d.dcm": 132, "/inner/x": 9, "/in2": 3}
    return spark.createDataFrame([(p, n, None) for p, n in sizes.items()], "path string, byte_size long, modified_at timestamp")


def test_listing_is_recursive_on_demand(inventory):
    assert rows(files.list_files(inventory, "/in"), "relative_path", "byte_size") == [
        ("a.dcm", 133), ("b.txt", 5), ("sub/c.dcm", 500), ("sub/deep/d.dcm", 132),
    ]
    assert rows(files.list_files(inventory, "/in/", recursive=False), "relative_path") == [("a.dcm",), ("b.txt",)]


def test_listing_keeps_hidden_files(spark):
    hidden = spark.createDataFrame([(f"/in/{n}", 1, None) for n in ("a.dcm", "_b.dcm", ".c.dcm", "_d/e")], "path string, byte_size long, modified_at timestamp")
    assert rows(files.list_files(hidden, "/in"), "relative_path") == [(".c.dcm",), ("_b.dcm",), ("_d/e",), ("a.dcm",)]


def test_paths_sort_part_by_part(spark):
    listing = spark.createDataFrame([("a-b/x", 1), ("a/x", 1), ("a/b/x", 1)], "relative_path string, byte_size long")
    got = rows(files.scan_files(listing, max_items=2), "relative_path", "error_code")
    assert got == [("", V.MAX_ITEMS), ("a/b/x", None), ("a/x", None)]


@pytest.mark.parametrize(
    "max_items, expected",
    [
        (None, [("a.dcm", None), ("b.txt", None), ("sub/c.dcm", V.FILE_TOO_LARGE), ("sub/deep/d.dcm", None)]),
        (3, [("a.dcm", None), ("b.txt", None), ("sub/c.dcm", V.FILE_TOO_LARGE), ("sub/deep/d.dcm", None)]),
        (2, [("", V.MAX_ITEMS), ("a.dcm", None), ("b.txt", None)]),
        (0, [("", V.MAX_ITEMS)]),
    ],
)
def test_scan_limits(inventory, max_items, expected):
    scanned = files.scan_files(files.list_files(inventory, "/in"), max_items, max_file_bytes=200)
    assert rows(scanned, "relative_path", "error_code") == expected


def test_magic_of_real_files(spark, folder):
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    got = files.magic_sniff(raw).select(F.element_at(F.split("path", "/"), -1), "is_candidate")
    assert rows(got) == [("a.dcm", True), ("b.txt", False), ("c.dcm", False), ("d.dcm", True)]


def test_explicit_list(spark):
    entries = spark.createDataFrame([("/in/a",), ("/in/../etc/x",), ("/in/x/../b",), ("/in/none",), ("/inside/a",)], "path string")
    listing = spark.createDataFrame([("/in/a", 1), ("/in/b", 2), ("/inside/a", 3)], "path string, byte_size long")
    assert rows(files.scan_file_list(entries, listing, ["/in/"]), "path", "relative_path", "error_code") == [
        ("/etc/x", None, V.OUTSIDE_ROOT), ("/in/a", "a", None), ("/in/b", "b", None), ("/in/none", None, V.FILE_NOT_FOUND),
        ("/inside/a", None, V.OUTSIDE_ROOT),
    ]


def test_curated_samples_and_annotations(spark):
    listing = spark.createDataFrame(
        [(p, 1) for p in (
            "/m/data/s1/x.dcm", "/m/data/s1/y/z.dcm", "/m/data/s2.dcm", "/m/data/s3/a.dcm", "/m/data/s3.dcm", "/m/data/s4.tar.gz",
            "/m/ann/s1.json", "/m/ann/s1/mask.png", "/m/ann/s2/mask.png", "/m/ann/s4.tar", "/m/other/s1.json",
        )],
        "path string, byte_size long",
    )
    samples = manifests.curated_samples(listing, "/m/data/")
    assert rows(samples, "path", "sample_id", "error_code") == [
        ("/m/data/s1/x.dcm", "s1", None), ("/m/data/s1/y/z.dcm", "s1", None), ("/m/data/s2.dcm", "s2", None),
        ("/m/data/s3.dcm", "s3", V.DUPLICATE_SAMPLE), ("/m/data/s3/a.dcm", "s3", V.DUPLICATE_SAMPLE), ("/m/data/s4.tar.gz", "s4.tar", None),
    ]
    specs = [manifests.AnnotationSpec("/m/ann", "mask", True, "seg"), manifests.AnnotationSpec("/m/other/", "text")]
    matched = manifests.curated_annotations(samples.where("error_code IS NULL"), listing, specs)
    assert rows(matched, "sample_id", "label", "match_path", "missing_required") == [
        ("s1", "mask", "/m/ann/s1.json", False), ("s1", "text", "/m/other/s1.json", False), ("s2", "mask", "/m/ann/s2", False),
        ("s2", "text", None, False), ("s4.tar", "mask", "/m/ann/s4.tar", False), ("s4.tar", "text", None, False),
    ]
    gone = manifests.curated_annotations(samples, listing.where("path NOT LIKE '/m/ann%'"), specs)
    assert rows(manifests.missing_annotations(gone)) == [("s1", "mask"), ("s2", "mask"), ("s3", "mask"), ("s4.tar", "mask")]


def test_content_store_plan(spark):
    blobs = spark.createDataFrame(
        [(1, bytearray(b"a"), None), (2, bytearray(b"a"), None), (3, bytearray(b"b"), "00"), (4, bytearray(b"b"), None), (5, bytearray(b"c"), None)],
        "item_id int, content binary, declared_sha256 string",
    )
    held = spark.createDataFrame([(bytearray(b"c"),)], "c binary").select(F.sha2("c", 256).alias("sha256"))
    assert rows(store.content_store_plan(blobs, held), "item_id", "action") == [
        (1, "store"), (2, "already_stored"), (3, "hash_mismatch"), (4, "store"), (5, "already_stored"),
    ]


def test_written_partitions_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_partitioned(spark.createDataFrame([("a", 1), ("b", 2)], "job_id string, n int"), path, "job_id")
    for _ in range(2):
        store.write_partitioned(spark.createDataFrame([("b", 3), ("b", 4)], "job_id string, n int"), path, "job_id")
    assert rows(spark.read.parquet(path), "job_id", "n") == [("a", 1), ("b", 3), ("b", 4)]
