"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.llm.bounded_packing import pack_online
from obsledger.llm.decontamination import contaminated
from obsledger.llm.fingerprints import fingerprint_documents
from obsledger.llm.importance import resample
from obsledger.llm.ngram_join import similar_documents
from obsledger.llm.packing import pack_documents
from obsledger.llm.ppm import score_documents
from obsledger.llm.prefix_trie import conversation_trie
from obsledger.llm.sharding import shard_documents
from obsledger.llm.token_counts import count_pieces
from obsledger.llm.toxicity import score_toxicity
from obsledger.llm.url_filters import judge_urls
from obsledger.llm.warc import resolve_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed values of the checked queries.
SHARDS = 24
TOKEN_LIMIT = 4096
SEQUENCE_TOKENS = 2048
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_sampled_splitters")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


OP8_SQL = r"""
WITH RECURSIVE
p AS (
  SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (SELECT * FROM (VALUES ('allow', 'org', '/', 'org/'), ('block', 'example.org', '/es/', 'example.org/es/'),
  ('block', 'example.org', '/en/1', 'example.org/en/1'), ('allow', 'com', '/fr/', 'com/fr/'),
  ('block', 'com', '/de/', 'com/de/')) v(verdict, rhost, rpath, rule)),
fits AS (
  SELECT page_id, url, host, path, rule, verdict
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1),
links AS (
  SELECT url AS a, host, path, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, unnest([url,
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS t
  FROM p WHERE url IS NOT NULL),
targets AS (
  SELECT a, CASE WHEN t = a OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN scheme || ':' || t
    WHEN starts_with(t, '/') THEN scheme || '://' || host || t
    ELSE scheme || '://' || host || regexp_replace(path, '[^/]*$', '') || t END AS t
  FROM links WHERE t <> ''),
forms AS (
  SELECT a, regexp_replace(translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(www|m)\.', '') AS host,
    regexp_replace(regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(t, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$'))) AS kept
  FROM targets),
edges AS (
  SELECT DISTINCT a, host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS b FROM forms),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
  SELECT a, a FROM both_ways
  UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
classes AS (SELECT node, min(other) AS url_class FROM reach GROUP BY node),
shared AS (
  SELECT url_class, bool_or(coalesce(verdict = 'block', false)) AND NOT bool_or(coalesce(verdict = 'allow', false)) AS blocked
  FROM fits JOIN classes ON url = node GROUP BY url_class)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, url_class
FROM fits LEFT JOIN classes ON url = node LEFT JOIN shared USING (url_class)
"""


@query("op8_redirect_equivalence", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op5_pre_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op7_exact_complement")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


@query("op10_grouped_prefix_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_boosted_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_improbable_features")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op4_partial_matching")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response, and a later revisit of its address with some of its validators."""
    tag, choice = F.md5("html"), F.conv(F.substring(F.md5("url"), 1, 4), 16, 10).cast("int")
    day = F.concat(F.lit("day "), (F.col("page_id") % 100).cast("string"))
    pages = pages.select("page_id", "url", tag.alias("tag"), choice.alias("choice"), day.alias("day"), F.length("html").cast("string").alias("size"))
    response = pages.select(
        (2 * F.col("page_id")).alias("record_id"),
        "url",
        (2 * F.col("page_id")).alias("at"),
        F.lit("response").alias("kind"),
        F.lit(200).alias("status"),
        F.col("tag").alias("digest"),
        F.create_map(
            F.lit("ETag"), F.concat(F.lit('"'), "tag", F.lit('"')), F.lit("Last-Modified"), F.col("day"), F.lit("Date"), F.col("day"),
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size"),
        ).alias("headers"),
    )
    later = 2 * F.col("page_id") + 1 + 2 * F.col("choice")
    own_tag = F.concat(F.lit('W/"'), F.when(F.col("choice") % 5 == 0, F.lit("changed")).otherwise(F.col("tag")), F.lit('"'))
    revisit = pages.select(
        (2 * F.col("page_id") + 1).alias("record_id"),
        "url",
        later.alias("at"),
        F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        F.when(F.col("choice") % 3 == 2, F.col("tag")).alias("digest"),
        F.map_filter(
            F.create_map(
                F.lit("etag"), F.when(F.col("choice") % 3 == 0, own_tag), F.lit("last-modified"), F.when(F.col("choice") % 3 == 1, F.col("day")),
                F.lit("date"), later.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=60"),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url, md5(html) AS tag, CAST('0x' || substr(md5(url), 1, 4) AS INTEGER) AS choice,
    'day ' || CAST(page_id % 100 AS VARCHAR) AS day, CAST(length(html) AS VARCHAR) AS size,
    regexp_replace(translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(www|m)\.', '')
    || regexp_replace(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$'))) AS kept
  FROM pages),
k AS (SELECT *, place || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url_key FROM p),
r AS (SELECT 2 * page_id + 1 AS record_id, url_key, 2 * page_id + 1 + 2 * choice AS revisit_at,
    CASE WHEN choice % 3 = 0 THEN CASE WHEN choice % 5 = 0 THEN 'changed' ELSE tag END END AS etag,
    CASE WHEN choice % 3 = 1 THEN day END AS changed, CASE WHEN choice % 3 = 2 THEN tag END AS digest, choice FROM k),
m AS (
  SELECT r.record_id, r.url_key, r.revisit_at, r.etag, r.changed, r.digest, 2 * k.page_id AS response_id, k.tag, k.day, k.size
  FROM r LEFT JOIN k ON k.url_key = r.url_key AND (2 * k.page_id < r.revisit_at OR (2 * k.page_id = r.revisit_at AND 2 * k.page_id < r.record_id))
  QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY k.page_id DESC NULLS LAST) = 1),
s AS (SELECT *, coalesce(etag = tag, changed = day, digest = tag) AS same FROM m),
d AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_response' WHEN same IS NULL THEN 'no_validator'
    WHEN same THEN 'resolved' ELSE 'validator_mismatch' END AS state FROM s)
SELECT record_id, url_key, revisit_at, response_id, response_id AS response_at,
  CASE WHEN state = 'resolved' THEN tag END AS digest, state,
  CASE WHEN state = 'resolved' THEN 'cache-control: max-age=60; content-length: ' || size || '; content-type: text/html; date: '
    || CAST(revisit_at AS VARCHAR) || '; etag: ' || CASE WHEN etag IS NOT NULL THEN 'W/' ELSE '' END || '"' || tag || '"'
    || '; last-modified: ' || day END AS headers
FROM d
"""


@query("op1_revisit_resolution", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.sort_array(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return resolved.withColumn("headers", F.when(F.col("headers").isNotNull(), F.array_join(lines, "; ")))


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first_id, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, bit: xor(a >> 1, (a & 1) * 3988292384)))) % 9 AS h
  FROM turns GROUP BY conv_id),
taken AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first_id AND t.pos <= c.h),
rebuilt AS (
  SELECT * FROM taken
  UNION ALL
  SELECT t.conv_id, t.pos - c.h + coalesce(k.n, 0), t.role, t.text
  FROM turns t JOIN convs c USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS n FROM taken GROUP BY conv_id) k USING (conv_id)
  WHERE t.pos > c.h),
prefixes AS (
  SELECT conv_id, pos AS depth, strlen(text) AS size,
    string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS node
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
last AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
    CASE WHEN depth > 0 THEN left(node, 32 * (CAST(depth AS INT) - 1)) END AS parent
  FROM prefixes GROUP BY node, depth),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.node, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids USING (node) JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.node),
ends AS (
  SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM prefixes JOIN last USING (conv_id, depth) GROUP BY node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids ON kids.node = n.node LEFT JOIN ends e ON e.node = n.node
"""


@query("op11_halved_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH codes AS (SELECT list_reduce(list_prepend(CAST(i AS BIGINT), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, bit: xor(a >> 1, (a & 1) * 3988292384)) AS code, i FROM range(256) r(i)),
crc AS (SELECT list(code ORDER BY i) AS t FROM codes),
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, doc_id, row_number() OVER () AS row_no, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT row_no, side, unnest(w || list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS f FROM words),
counted AS (SELECT row_no, side, f, count(*) AS n FROM features GROUP BY ALL),
spelled AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i+1] AS BIGINT))),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) % 10000 AS bucket FROM spelled, crc),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t FROM counted JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM sums, totals),
sized AS (
  SELECT w.doc_id, w.row_no, len(w.w) AS n_words, greatest(2 * len(w.w) - 1, 0) AS n_features, coalesce(g.gain, 0) AS gain
  FROM words w LEFT JOIN (SELECT row_no, CAST(sum(n * gain) AS BIGINT) AS gain FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no) g USING (row_no)
  WHERE side = 'd'),
weighed AS (
  SELECT *, CASE WHEN n_features > 0 THEN (gain - ((gain % n_features + n_features) % n_features)) // n_features ELSE 0 END AS weight,
    CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[:8] AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS noise FROM sized),
placed AS (SELECT *, weight + noise AS score, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST) END AS place FROM weighed)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 25 * count(*) // 100 FROM placed WHERE n_words >= 20) THEN place END AS rank FROM placed
"""


@query("op12_segment_deduplicated_resampling", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_bounded_space_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_online(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
