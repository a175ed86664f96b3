"""Queries over sources, the content store, written tables and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.operators.review import terminal_items
from obsledger.plans import fixtures as X
from obsledger.plans.canonical_queries import FLAGGED
from obsledger.plans.registry import query
from obsledger.session import run_folder
from obsledger.sources import archives, files, manifest_json, manifests, store
from obsledger.streaming import ingest, metrics, progress


# --- files -------------------------------------------------------------------------------


@query("list_files", """
SELECT path, substr(path, 7) AS relative_path, n AS byte_size FROM (
  SELECT CASE page_id % 4 WHEN 0 THEN '/data/_p' WHEN 1 THEN '/data/.h/p' WHEN 2 THEN '/database/p' ELSE '/data/a/b/p' END || page_id AS path, length(html) AS n FROM pages)
WHERE path LIKE '/data/%'""")
def list_files(spark, sf):
    """An inventory with hidden files and folders, and a neighbour whose name begins alike."""
    front = X.pick(F.col("page_id") % 4, ["/data/_p", "/data/.h/p", "/database/p", "/data/a/b/p"])
    inventory = X.table(spark, sf, "pages").select(
        F.concat(front, F.col("page_id").cast("string")).alias("path"), F.length("html").cast("bigint").alias("byte_size"),
        F.lit(None).cast("timestamp").alias("modified_at"),
    )
    return files.list_files(inventory, "/data").select("path", "relative_path", "byte_size")


SCAN_ITEMS, SCAN_BYTES = 200, 9000


@query("scan_files", f"""
WITH l AS (SELECT *, string_split(relative_path, '/') AS parts FROM (SELECT url || '#' || page_id AS relative_path, length(html) AS byte_size FROM pages)),
i AS (SELECT * FROM l WHERE byte_size <= {SCAN_BYTES} ORDER BY parts LIMIT {SCAN_ITEMS}),
e AS (SELECT CASE WHEN count(*) >= {SCAN_ITEMS} THEN max(parts) END AS last FROM i)
SELECT relative_path, byte_size, NULL AS error_code, NULL AS error_detail FROM i
UNION ALL SELECT relative_path, byte_size, 'FileTooLarge', CAST(byte_size AS VARCHAR) FROM l, e WHERE byte_size > {SCAN_BYTES} AND (last IS NULL OR parts < last)
UNION ALL SELECT * FROM (SELECT DISTINCT '', NULL, 'MaxItemsExceeded', '{SCAN_ITEMS}' FROM l, e WHERE parts > last)""")
def scan_files(spark, sf):
    listing = X.table(spark, sf, "pages").select(
        F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("relative_path"),
        F.length("html").cast("bigint").alias("byte_size"),
    )
    return files.scan_files(listing, SCAN_ITEMS, SCAN_BYTES)


@query("scan_file_list", """
SELECT path, CASE WHEN code IS NULL THEN substr(path, 10) END AS relative_path, CASE WHEN code IS NULL THEN n END AS byte_size, code AS error_code,
       CASE code WHEN 'ManifestPathOutsideAllowedRoot' THEN 'outside allowed roots' WHEN 'ManifestFileNotFound' THEN 'not a file' END AS error_detail
FROM (SELECT *, CASE WHEN path NOT LIKE '/data/in/%' THEN 'ManifestPathOutsideAllowedRoot' WHEN url NOT LIKE 'https%' THEN 'ManifestFileNotFound' END AS code
      FROM (SELECT url, length(html) AS n, CASE page_id % 4 WHEN 3 THEN '/data/inner/p' WHEN 2 THEN '/data/p' ELSE '/data/in/p' END || page_id || '.dcm' AS path FROM pages))""")
def scan_file_list(spark, sf):
    page = F.col("page_id").cast("string")
    pages = X.table(spark, sf, "pages")
    front = X.pick(F.col("page_id") % 4, ["/data/in/p", "/data/./in//x/../p", "/data/in/../p", "/data/inner/p"])
    entries = pages.select(F.concat(front, page, F.lit(".dcm")).alias("path"))
    listing = pages.where("url LIKE 'https%'").select(
        F.concat(F.lit("/data/in/p"), page, F.lit(".dcm")).alias("path"), F.length("html").cast("bigint").alias("byte_size")
    )
    return files.scan_file_list(entries, listing, ["/srv/none", "/data/in"])


@query("magic_sniff", """
SELECT doc_id, (lang = 'fr' OR (lang = 'de' AND n_chars > 200)) AND length(source) = 4 AS is_candidate FROM documents""")
def magic_sniff(spark, sf):
    """Bytes whose first 132 are made up by language: the right magic, a cut one, or none."""
    preamble = F.rpad("source", 128, "-")
    whole = F.when(F.col("lang") == "fr", F.concat(preamble, F.lit("DICM"), "text")).when(
        F.col("lang") == "de", F.when(F.col("n_chars") > 200, F.concat(preamble, F.lit("DICM"))).otherwise(F.concat(preamble, F.lit("DIC")))
    ).otherwise(F.concat(preamble, F.lit("XICM"), "text"))
    content = F.encode(F.when(F.length("source") == 4, whole).otherwise(F.concat(F.lit("x"), whole)), "UTF-8")
    docs = X.table(spark, sf, "documents").select("doc_id", content.alias("content"))
    return files.magic_sniff(docs).select("doc_id", "is_candidate")


@query("scan_totals", """
SELECT job_id, count(*) AS total_items, CAST(sum(byte_size) AS BIGINT) AS total_bytes, count(*) FILTER (WHERE scan_status = 'completed') AS candidate_items,
       count(*) FILTER (WHERE scan_status NOT IN ('completed', 'rejected')) AS other_items, count(*) FILTER (WHERE scan_status = 'rejected') AS rejected_items FROM v_item GROUP BY job_id""")
def scan_totals(spark, sf):
    verdict = F.when(F.col("scan_status") == "completed", "candidate").when(F.col("scan_status") == "rejected", "rejected").otherwise("other")
    return files.scan_totals(X.items(spark, sf).withColumn("verdict", verdict))


CURATED = {
    "v_data": """SELECT path, max(n_chars) AS byte_size FROM (SELECT n_chars, CASE WHEN lang = 'en' THEN '/m/data/s' || (doc_id % 300) || '/f' || doc_id || '.dcm'
        ELSE '/m/data/s' || doc_id || '.v1.dcm' END AS path FROM documents) GROUP BY path""",
    "v_sample": """SELECT path, byte_size, CASE WHEN path LIKE '/m/data/%/%' THEN split_part(path, '/', 4) ELSE regexp_replace(split_part(path, '/', 4), '\\.dcm$', '') END AS sample_id,
        CASE WHEN path LIKE '/m/data/%/%' THEN 'dir:' ELSE 'file:' END || split_part(path, '/', 4) AS container FROM v_data""",
    "v_found": """SELECT 0 AS spec_no, 's' || doc_id AS sample_id, CASE WHEN quality = 1 THEN '/m/ann/masks/s' || doc_id || '.json' WHEN toxic = 1 THEN '/m/ann/masks/s' || doc_id END AS match_path
        FROM labels WHERE quality = 1 OR toxic = 1
        UNION ALL SELECT 1, 's' || doc_id, '/m/ann/boxes/s' || doc_id FROM labels WHERE toxic = 0""",
}

SPECS = [
    manifests.AnnotationSpec("/m/ann/masks", "mask", required=True, task_type="segmentation"),
    manifests.AnnotationSpec("/m/ann/boxes/", "box", required=False, task_type="detection"),
    manifests.AnnotationSpec("/m/ann/none", "report", required=True),
]


def data_listing(spark, sf):
    doc = F.col("doc_id")
    path = F.when(
        F.col("lang") == "en",
        F.concat(F.lit("/m/data/s"), (doc % 300).cast("string"), F.lit("/f"), doc.cast("string"), F.lit(".dcm")),
    ).otherwise(F.concat(F.lit("/m/data/s"), doc.cast("string"), F.lit(".v1.dcm")))
    return X.table(spark, sf, "documents").groupBy(path.alias("path")).agg(F.max("n_chars").alias("byte_size"))


def annotation_listing(spark, sf):
    """Of a good item a json file and, if it is also toxic, a folder; of the rest a plain file."""
    labels = X.table(spark, sf, "labels").withColumn("s", F.concat(F.lit("s"), F.col("doc_id").cast("string")))
    parts = [
        labels.where("quality = 1").select(F.concat(F.lit("/m/ann/masks/"), "s", F.lit(".json")).alias("path")),
        labels.where("toxic = 1").select(F.concat(F.lit("/m/ann/masks/"), "s", F.lit("/a/b.png")).alias("path")),
        labels.where("toxic = 0").select(F.concat(F.lit("/m/ann/boxes/"), "s").alias("path")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("curated_samples", """
SELECT path, byte_size, sample_id, container, CASE WHEN count(DISTINCT container) OVER (PARTITION BY sample_id) > 1 THEN 'DuplicateCuratedSampleId' END AS error_code FROM (
  SELECT path, byte_size, CASE WHEN path LIKE '/m/data/%/%' THEN split_part(path, '/', 4) ELSE regexp_replace(split_part(path, '/', 4), '\\.dcm$', '') END AS sample_id,
         CASE WHEN path LIKE '/m/data/%/%' THEN 'dir:' ELSE 'file:' END || split_part(path, '/', 4) AS container
  FROM (SELECT CASE WHEN path LIKE '%.v1.dcm' THEN replace(path, '.v1', '') ELSE path END AS path, byte_size FROM v_data))""", CURATED)
def curated_samples(spark, sf):
    listing = data_listing(spark, sf).withColumn("path", F.regexp_replace("path", r"\.v1\.dcm$", ".dcm"))
    return manifests.curated_samples(listing, "/m/data")


@query("curated_annotations", """
SELECT sample_id, spec_no, label, task_type, match_path, required AND match_path IS NULL AS missing_required
FROM (SELECT * FROM (SELECT DISTINCT sample_id FROM v_sample),
     (VALUES (0, 'mask', 'segmentation', true), (1, 'box', 'detection', false), (2, 'report', NULL, true)) p(spec_no, label, task_type, required)) s
LEFT JOIN v_found f USING (sample_id, spec_no)""", CURATED)
def curated_annotations(spark, sf):
    samples = manifests.curated_samples(data_listing(spark, sf), "/m/data")
    return manifests.curated_annotations(samples, annotation_listing(spark, sf), SPECS)


@query("missing_annotations", """
SELECT sample_id, concat_ws(', ', CASE WHEN sample_id NOT IN (SELECT sample_id FROM v_found WHERE spec_no = 0) THEN 'mask' END, 'report') AS missing_annotations
FROM (SELECT DISTINCT sample_id FROM v_sample)""", CURATED)
def missing_annotations(spark, sf):
    return manifests.missing_annotations(curated_annotations(spark, sf))


# --- manifests as JSON text --------------------------------------------------------------

PACKAGE_FILES = [  # name within the package, and the condition on its number
    ("data/s1.dcm", "true"), ("data/s2/a.dcm", "true"), ("data/s1/x.dcm", "doc_id % 7 = 0"), ("masks/s1.json", "doc_id % 3 <> 0"), ("masks/s1/q.png", "true"),
    ("masks/s2/m.png", "doc_id % 4 <> 0"), ("boxes/s2", "doc_id % 2 = 0"), ("boxes/other", "true"), ("readme.txt", "true"),
]
PACKAGE_TEXTS = [  # by number modulo 20; the last one for all others
    None, "{oops", "[1]", "{}", '{"data": 5}', '{"data": "/out/data"}', '{"data": "../up"}', '{"data": "readme.txt"}',
    '{"data": "data", "annotation": {"path": "masks"}}',
    '{"data": "data", "annotation": [7, {}, {"path": "", "required": true}, {"path": "gone/", "required": true}, {"path": "/out/x", "name": "far", "required": "no"}, {"path": "masks"}]}',
    '{"data": {"path": "./data"}, "annotation": [{"path": "masks", "name": "mask", "required": true, "task_type": " seg "}, {"path": "boxes/", "label_name": "box", "required": 0}]}',
]

PACKAGES = {
    "v_package": "SELECT doc_id, '/pkg/' || doc_id AS dir, '/pkg/' || doc_id || '/data_manifest.json' AS manifest_path, CASE least(doc_id % 20, 10) "
    + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(PACKAGE_TEXTS) if t is not None) + " END AS content FROM documents",
    "v_package_file": "SELECT dir, unnest([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in PACKAGE_FILES) + "]) AS name FROM v_package",
    "v_place": """SELECT DISTINCT dir || '/' || name AS place, false AS is_dir FROM v_package_file WHERE name IS NOT NULL
        UNION SELECT dir || '/' || array_to_string(string_split(name, '/')[:n], '/'), true FROM v_package_file, range(1, 5) r(n) WHERE n < len(string_split(name, '/'))""",
    "v_manifest": """SELECT *, CASE WHEN content IS NULL THEN 'CuratedManifestUnreadable|manifest unreadable' WHEN j IS NULL THEN 'CuratedManifestInvalidJson|manifest is not valid JSON'
          WHEN json_type(j) <> 'OBJECT' THEN 'CuratedManifestInvalidJson|manifest root must be an object'
          WHEN coalesce(json_type(j, '$.data'), 'NULL') = 'NULL' THEN 'CuratedManifestMissingDataPath|manifest missing data path'
          WHEN coalesce(trim(given), '') = '' THEN 'CuratedManifestMissingDataPath|manifest data path is empty'
          WHEN root NOT LIKE '/pkg/%' THEN 'CuratedManifestDataPathOutsideAllowedRoot|path outside allowed roots'
          WHEN root NOT IN (SELECT place FROM v_place) THEN 'CuratedManifestDataPathInvalid|path does not exist'
          WHEN root NOT IN (SELECT place FROM v_place WHERE is_dir) THEN 'CuratedManifestDataPathInvalid|path is not a directory' END AS problem
        FROM (SELECT *, CASE WHEN given LIKE '/%' THEN given WHEN given LIKE '../%' THEN '/pkg/' || given[4:] WHEN given LIKE './%' THEN dir || given[2:] ELSE dir || '/' || given END AS root
          FROM (SELECT *, CASE json_type(j, '$.data') WHEN 'OBJECT' THEN j ->> '$.data.path' WHEN 'VARCHAR' THEN j ->> '$.data' END AS given
            FROM (SELECT *, CASE WHEN json_valid(content) THEN CAST(content AS JSON) END AS j FROM v_package)))""",
    "v_spec": """SELECT *, CASE WHEN json_type(e) <> 'OBJECT' THEN 'must be an object' WHEN json_type(e, '$.path') IS DISTINCT FROM 'VARCHAR' OR trim(e ->> '$.path') = '' THEN 'missing path' END AS wrong,
          rtrim(CASE WHEN e ->> '$.path' LIKE '/%' THEN e ->> '$.path' ELSE dir || '/' || (e ->> '$.path') END, '/') AS spec_root,
          coalesce(json_type(e, '$.required') = 'VARCHAR' OR e ->> '$.required' = 'true', false) AS required,
          coalesce(e ->> '$.name', e ->> '$.label_name', regexp_extract(rtrim(e ->> '$.path', '/'), '[^/]*$')) AS label, nullif(trim(e ->> '$.task_type'), '') AS task_type
        FROM (SELECT manifest_path, dir, unnest(range(len(l))) AS spec_no, unnest(l) AS e
          FROM (SELECT manifest_path, dir, CAST(j -> '$.annotation' AS JSON[]) AS l FROM v_manifest WHERE problem IS NULL AND json_type(j, '$.annotation') = 'ARRAY'))""",
    "v_sample_file": """SELECT *, count(DISTINCT container) OVER (PARTITION BY manifest_path, sample_id) > 1 AS repeated FROM (
        SELECT manifest_path, dir, name AS relative_path, CASE WHEN name LIKE 'data/%/%' THEN 'dir' ELSE 'file' END AS container, regexp_extract(name, 'data/([^/.]*)', 1) AS sample_id
        FROM v_manifest JOIN v_package_file USING (dir) WHERE problem IS NULL AND name LIKE 'data/%')""",
    "v_gone": "SELECT * FROM v_spec WHERE wrong IS NULL AND (spec_root NOT LIKE '/pkg/%' OR spec_root NOT IN (SELECT place FROM v_place))",
}


def packages(spark, sf):
    """Manifests and the files of their packages."""
    docs = X.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("/pkg/"), F.col("doc_id").cast("string")).alias("dir"))
    content = X.pick(F.least(F.col("doc_id") % 20, F.lit(10)).cast("int"), [t or "" for t in PACKAGE_TEXTS])
    manifests_ = docs.select(F.concat("dir", F.lit("/data_manifest.json")).alias("manifest_path"), F.when(F.col("doc_id") % 20 != 0, content).alias("content"))
    names = F.explode(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in PACKAGE_FILES]))
    files_ = docs.select("dir", names.alias("name")).where("name IS NOT NULL")
    listing = files_.select(F.concat("dir", F.lit("/"), "name").alias("path"), F.length("name").cast("bigint").alias("byte_size"))
    return manifest_json.read_manifests(manifests_, listing, ["/pkg"]), listing


@query("manifest_specs", """
SELECT manifest_path, CAST(spec_no AS INTEGER) AS spec_no, spec_root AS root, label, required, task_type FROM v_spec
WHERE wrong IS NULL AND (manifest_path, spec_no) NOT IN (SELECT (manifest_path, spec_no) FROM v_gone)""", PACKAGES)
def manifest_specs(spark, sf):
    return packages(spark, sf)[0].specs.drop("source_path")


@query("manifest_errors", """
SELECT manifest_path, 'data_manifest.json' AS path, split_part(problem, '|', 1) AS error_code, split_part(problem, '|', 2) AS error_detail FROM v_manifest WHERE problem IS NOT NULL
UNION ALL SELECT manifest_path, 'data_manifest.json', 'CuratedManifestInvalidJson', 'annotation must be a list' FROM v_manifest WHERE problem IS NULL AND json_type(j, '$.annotation') = 'OBJECT'
UNION ALL SELECT manifest_path, 'data_manifest.json', 'CuratedManifestInvalidJson', 'annotation[' || spec_no || '] ' || wrong FROM v_spec WHERE wrong IS NOT NULL
UNION ALL SELECT manifest_path, e ->> '$.path', CASE WHEN spec_root LIKE '/pkg/%' THEN 'AnnotationPathMissing' ELSE 'AnnotationPathOutsideAllowedRoot' END,
  CASE WHEN spec_root LIKE '/pkg/%' THEN 'annotation path does not exist' ELSE 'path outside allowed roots' END FROM v_gone
UNION ALL SELECT manifest_path, relative_path, 'DuplicateCuratedSampleId', sample_id FROM v_sample_file WHERE repeated""", PACKAGES)
def manifest_errors(spark, sf):
    return manifest_json.curated_items(*packages(spark, sf))[1]


@query("manifest_items", """
SELECT f.manifest_path, relative_path, CAST(strlen(relative_path) AS BIGINT) AS byte_size, sample_id, coalesce(refs, '') AS refs, concat_ws(',', gaps, lost) AS missing
FROM v_sample_file f LEFT JOIN (
  SELECT manifest_path, sample_id, string_agg(spec_no || ':' || match_path || ':' || label || ':' || coalesce(task_type, '-') || ':' || required, ',' ORDER BY spec_no) AS refs,
    string_agg(CASE WHEN required AND match_path IS NULL THEN label END, ',' ORDER BY spec_no) AS gaps
  FROM (SELECT s.*, p.sample_id, CASE WHEN a.place IS NOT NULL THEN a.place[len(s.dir) + 2:] WHEN b.place IS NOT NULL THEN b.place[len(s.dir) + 2:] END AS match_path
    FROM v_spec s JOIN (SELECT DISTINCT manifest_path, sample_id FROM v_sample_file WHERE NOT repeated) p USING (manifest_path)
    LEFT JOIN (SELECT DISTINCT place FROM v_place WHERE NOT is_dir) a ON a.place = spec_root || '/' || sample_id || '.json'
    LEFT JOIN (SELECT DISTINCT place FROM v_place) b ON b.place = spec_root || '/' || sample_id
    WHERE wrong IS NULL AND (manifest_path, spec_no) NOT IN (SELECT (manifest_path, spec_no) FROM v_gone))
  GROUP BY manifest_path, sample_id) m USING (manifest_path, sample_id)
LEFT JOIN (SELECT manifest_path, string_agg(label, ',' ORDER BY spec_no) AS lost FROM v_gone WHERE required GROUP BY manifest_path) g USING (manifest_path)
WHERE NOT repeated""", PACKAGES)
def manifest_items(spark, sf):
    items, _ = manifest_json.curated_items(*packages(spark, sf))
    text = lambda a: F.concat_ws(":", a["spec_no"].cast("string"), a["path"], a["label"], F.coalesce(a["task_type"], F.lit("-")), a["required"].cast("string"))
    return items.select(
        "manifest_path", "relative_path", "byte_size", "sample_id", F.array_join(F.transform("annotations", text), ",").alias("refs"),
        F.array_join("missing", ",").alias("missing"),
    )


# --- archives and the content store ------------------------------------------------------

LIMITS = {**V.ARCHIVE_LIMITS, "max_total_bytes": 130_000_000, "max_entry_count": 10_000}

ARCHIVE = {
    "v_entry": r"""SELECT 'a' || (doc_id % 97) AS archive_id, doc_id AS entry_no,
        CASE doc_id % 50 WHEN 0 THEN '../x' WHEN 1 THEN 'a/../../b' WHEN 2 THEN 'a/./../b' WHEN 3 THEN 'a..b/c' WHEN 4 THEN 'a\..\b' WHEN 5 THEN '/../etc' WHEN 6 THEN 'a\../b'
          ELSE lang || '/' || doc_id || '.dcm' END AS name,
        doc_id % 50 IN (0, 1, 3, 6) AS unsafe,
        CASE WHEN doc_id % 31 = 0 THEN 60000000 WHEN doc_id % 29 = 0 THEN 2000000 ELSE n_chars END AS file_size,
        CASE WHEN doc_id % 29 = 0 THEN 1000 ELSE n_chars // 2 END AS compress_size, CASE WHEN doc_id % 83 = 0 THEN 5 ELSE 1 END AS depth FROM documents""",
}


def archive_entries(spark, sf):
    doc = F.col("doc_id")
    odd = ["../x", "a/../../b", "a/./../b", "a..b/c", "a\\..\\b", "/../etc", "a\\../b"]
    kind = doc % 50
    return X.table(spark, sf, "documents").select(
        F.concat(F.lit("a"), (doc % 97).cast("string")).alias("archive_id"), doc.alias("entry_no"),
        F.when(kind < 7, X.pick(F.least(kind, F.lit(6)), odd))
        .otherwise(F.concat("lang", F.lit("/"), doc.cast("string"), F.lit(".dcm"))).alias("name"),
        F.when(doc % 31 == 0, 60_000_000).when(doc % 29 == 0, 2_000_000).otherwise(F.col("n_chars")).alias("file_size"),
        F.when(doc % 29 == 0, 1000).otherwise(F.floor(F.col("n_chars") / 2)).alias("compress_size"),
        F.when(doc % 83 == 0, 5).otherwise(1).alias("depth"),
    )


@query("archive_safety", f"""
SELECT archive_id, entry_count, CAST(total_size AS BIGINT) AS total_size,
       CASE WHEN deep > 3 THEN 'NestedZipTooDeep' WHEN entry_count > 10000 OR total_size > {LIMITS["max_total_bytes"]} THEN 'ZipBombDetected'
            WHEN first_rule = 'path' THEN 'UnsafeArchivePath' WHEN first_rule IS NOT NULL THEN 'ZipBombDetected' END AS error_code,
       CASE WHEN deep > 3 THEN 'depth' WHEN entry_count > 10000 THEN 'entry_count' WHEN total_size > {LIMITS["max_total_bytes"]} THEN 'total_size' ELSE first_rule END AS rule
FROM (SELECT archive_id, max(depth) AS deep, count(*) AS entry_count, sum(file_size) AS total_size, arg_min(rule, entry_no) FILTER (WHERE rule IS NOT NULL) AS first_rule
      FROM (SELECT *, CASE WHEN unsafe THEN 'path' WHEN file_size > {V.ARCHIVE_LIMITS["max_entry_bytes"]} THEN 'entry_size'
                           WHEN compress_size > 0 AND file_size > 1048576 AND file_size / compress_size > 100 THEN 'ratio' END AS rule FROM v_entry) GROUP BY archive_id)""", ARCHIVE)
def archive_safety(spark, sf):
    return archives.archive_safety(archive_entries(spark, sf), LIMITS)


@query("content_store_plan", """
SELECT item_id, sha AS sha256, bytes AS byte_size, CASE WHEN declared <> sha THEN 'hash_mismatch' WHEN held OR item_id <> first_id THEN 'already_stored' ELSE 'store' END AS action
FROM (SELECT *, min(item_id) FILTER (WHERE declared IS NULL OR declared = sha) OVER (PARTITION BY sha) AS first_id,
             sha IN (SELECT sha256(text) FROM documents WHERE lang = 'fr') AS held
      FROM (SELECT doc_id AS item_id, sha256(text) AS sha, strlen(text) AS bytes,
                   CASE WHEN doc_id % 10 = 0 THEN 'deadbeef' WHEN doc_id % 10 > 1 THEN sha256(text) END AS declared FROM documents))""")
def content_store_plan(spark, sf):
    docs = X.table(spark, sf, "documents").withColumn("content", F.encode("text", "UTF-8"))
    kind = F.col("doc_id") % 10
    blobs = docs.select(
        F.col("doc_id").alias("item_id"), "content",
        F.when(kind == 0, "deadbeef").when(kind > 1, F.upper(F.sha2("content", 256))).alias("declared_sha256"),
    )
    held = docs.where("lang = 'fr'").select(F.sha2("content", 256).alias("sha256"))
    plan = store.content_store_plan(blobs, held)
    return plan.select("item_id", "sha256", F.col("byte_size").cast("bigint").alias("byte_size"), "action")


@query("ledger_write", """
SELECT job_id, item_id, source_path, outcome, error_code, error_detail, binding_status, index_status FROM v_item""")
def ledger_write(spark, sf):
    """Write the item reports, write those of some jobs again, and read the table back."""
    path = run_folder(spark, "ledger_write")
    report = terminal_items(X.items(spark, sf))
    store.write_partitioned(report.withColumn("error_detail", F.lit("draft")), path, "job_id")
    store.write_partitioned(report, path, "job_id")
    return spark.read.schema(report.schema).parquet(path).select(report.columns)


# --- streams -----------------------------------------------------------------------------


@query("stream_ingest", "SELECT observation_id, sop_instance_uid, is_canonical FROM v_flagged", FLAGGED)
def stream_ingest(spark, sf):
    folder = run_folder(spark, "stream_ingest")
    stream = X.observations(spark, sf, X.table_stream(spark, sf, "lineitem"))
    ingest.stream_ingest(stream, folder, f"{folder}/_checkpoint").awaitTermination()
    return ingest.ledger_state(spark, folder).select("observation_id", "sop_instance_uid", "is_canonical")


@query("stream_ingest_compacted", "SELECT observation_id, sop_instance_uid, is_canonical FROM v_flagged", FLAGGED)
def stream_ingest_compacted(spark, sf):
    """A batch per year, the first one delivered again at the end; runs are merged on the way, and what was merged is cleared."""
    folder, obs = run_folder(spark, "stream_ingest"), X.observations(spark, sf)
    years = sorted(r[0] for r in obs.select("job_id").distinct().collect())
    for no, year in enumerate([*years, years[0]]):
        ingest.process_batch(obs.where(F.col("job_id") == year), no, folder)
        if ingest.compact(spark, folder, fanout=2):
            ingest.clear(spark, folder)
    return ingest.ledger_state(spark, folder).select("observation_id", "sop_instance_uid", "is_canonical")


@query("stream_metrics", """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS n_failed
FROM (SELECT date_trunc('minute', ts) - to_minutes(back) AS w, status FROM v_event, (SELECT unnest([0, 1, 2, 3, 4]) AS back))
WHERE w + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) GROUP BY w""")
def stream_metrics(spark, sf):
    """Windows that the watermark has closed; the last ten minutes stay open."""
    folder = run_folder(spark, "stream_metrics")
    events = X.events(spark, sf, X.table_stream(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    rate = metrics.stream_rate(events)
    metrics.write_available(rate, f"{folder}/out", f"{folder}/_checkpoint").awaitTermination()
    closed = spark.read.schema(rate.schema).parquet(f"{folder}/out")
    return closed.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("stream_dedupe", """
SELECT sha256(job_id || ':local_folder:k' || item_id || ':1') AS item_fingerprint, job_id, item_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at
FROM (SELECT *, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 1 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY job_id, item_id ORDER BY ts, event_id) AS run
      FROM (SELECT *, lag(ts) OVER (PARTITION BY job_id, item_id ORDER BY ts, event_id) AS before FROM v_event))
GROUP BY job_id, item_id, run HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM v_event)""")
def stream_dedupe(spark, sf):
    """Runs of equal items that are closed: an hour's gap, and an hour for late events."""
    folder = run_folder(spark, "stream_dedupe")
    events = X.events(spark, sf, X.table_stream(spark, sf, "events"))
    items = events.select(
        "job_id", "item_id", F.concat(F.lit("k"), F.col("item_id").cast("string")).alias("source_path"), F.lit(1).alias("byte_size"),
        F.lit("local_folder").alias("source_kind"), F.col("ts").cast("timestamp").alias("ts"),
    )
    unique = metrics.stream_dedupe(items)
    metrics.write_available(unique, f"{folder}/out", f"{folder}/_checkpoint").awaitTermination()
    closed = spark.read.schema(unique.schema).parquet(f"{folder}/out")
    return closed.select("item_fingerprint", "job_id", "item_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("first_at"))


LIVE_LAG = {"v_live": "SELECT DISTINCT item_id, ts FROM v_event WHERE stage = 'metadata_persistence' AND ts < (SELECT max(ts) FROM v_event) - INTERVAL 4 DAY"}


@query("stream_index_lag", """
SELECT p.item_id, strftime(p.ts, '%Y-%m-%d %H:%M:%S.%f') AS persisted_at, (epoch_us(min(i.ts)) - epoch_us(p.ts)) / 1000000 AS lag_seconds
FROM v_live p LEFT JOIN v_event i ON i.item_id = p.item_id AND i.stage = 'indexing' AND i.ts BETWEEN p.ts AND p.ts + INTERVAL 48 HOUR
GROUP BY p.item_id, p.ts""", LIVE_LAG)
def stream_index_lag(spark, sf):
    """Persistence and indexing events joined as streams; what four days have closed."""
    folder = run_folder(spark, "stream_index_lag")
    events = X.events(spark, sf, X.table_stream(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    lags = progress.index_lags(events, "48 hours", "1 hour")
    metrics.write_available(lags, f"{folder}/out", f"{folder}/_checkpoint").awaitTermination()
    last = X.events(spark, sf).agg(F.max("ts").cast("timestamp")).first()[0]
    closed = spark.read.schema(lags.schema).parquet(f"{folder}/out").where(F.col("persisted_at") < F.lit(last) - F.expr("INTERVAL 4 DAYS"))
    return closed.withColumn("persisted_at", F.date_format("persisted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("stream_stuck_items", """
SELECT item_id, stage, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS since FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ts DESC, event_id DESC) AS back FROM v_event WHERE ts <= (SELECT max(ts) FROM v_event) - INTERVAL 2 DAY)
WHERE back = 1 AND status = 'in_progress' AND ts <= (SELECT max(ts) FROM v_event) - INTERVAL 2 DAY - INTERVAL 10 MINUTE""")
def stream_stuck_items(spark, sf):
    """Changes of a stream folded up to a time that its watermark has passed."""
    folder = run_folder(spark, "stream_stuck_items")
    events = X.events(spark, sf, X.table_stream(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    changes = progress.stuck_changes(events, 10, "1 hour")
    metrics.write_available(changes, f"{folder}/out", f"{folder}/_checkpoint").awaitTermination()
    last = X.events(spark, sf).agg(F.max("ts").cast("timestamp")).first()[0]
    passed = F.lit(last) - F.expr("INTERVAL 2 DAYS")
    stuck = progress.stuck_now(spark.read.schema(progress.CHANGE).parquet(f"{folder}/out").where(F.col("at") <= passed))
    return stuck.withColumn("since", F.date_format("since", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
