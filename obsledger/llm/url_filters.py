"""URL rules, and decisions carried over to the aliases of a page by redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.graph import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
QUERY = r"(?s)^[^?#]*\?([^#]*)"
CANONICAL_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
# Query parameters that only track visits and host prefixes that only pick a device: fixed values.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$"
DEVICE_HOST = r"^(www|m)\."


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def canonical_form(url: Column) -> Column:
    """Host without device prefix, path without trailing slashes, query without tracking parameters."""
    kept = F.filter(F.split(F.regexp_extract(url, QUERY, 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.sort_array(kept), "&"))).otherwise("")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.concat(F.regexp_replace(host_of(url), DEVICE_HOST, ""), path, query)


def _absolute(base: Column, target: Column) -> Column:
    """`target` against the page's address; a link without scheme, host or leading slash joins the page's folder."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .otherwise(F.concat(root, F.regexp_replace(path_of(base), r"[^/]*$", ""), target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between addresses that name one page: an address and its canonical form, the target
    of a canonical link, and the target of a redirect (refresh) in `html`. Null addresses give none."""
    url = F.col("url")
    links = F.array(
        F.regexp_extract(F.regexp_extract("html", CANONICAL_LINK, 0), HREF, 1),
        F.regexp_extract(F.regexp_extract("html", REFRESH, 0), REFRESH_URL, 1),
    )
    targets = F.transform(F.filter(links, lambda t: t.isNotNull() & (t != "")), lambda t: canonical_form(_absolute(url, t)))
    edges = (
        pages.where(url.isNotNull())
        .select(url.alias("a"), F.filter(links, lambda t: t.isNotNull() & (t != "")).alias("targets"))
        .select("a", F.explode(F.concat(F.array("a"), F.transform("targets", lambda t: _absolute(F.col("a"), t)))).alias("target"))
        .select("a", canonical_form(F.col("target")).alias("b"))
    )
    return edges.distinct()


def rule_match(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Longest rule (verdict, "host/path") that fits, as struct (rule, verdict), else null; allow wins ties."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Verdict per page: its own rule's, else that of its redirect-equivalence class.

    Classes are the connected components over `alias_edges`. In a class, one member that a rule
    allows keeps the others allowed; else one blocked member blocks all members without a rule;
    a class without either is allowed. Pages: (page_id, url, html); further columns are ignored
    and repeated rows are judged one by one. A null url, or one without "://", has empty host and
    path; a null url is in no class and is allowed unless a rule fits.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "_rule", rule_match(F.col("host"), F.col("path"), rules)
    )
    classes = connected_components(alias_edges(pages), "url_classes")
    marked = judged.where(F.col("url").isNotNull()).groupBy("url").agg(F.first("_rule.verdict").alias("_own"))
    marked = marked.join(classes, marked["url"] == classes["node"], "left").withColumn(
        "component", F.coalesce("component", "url")
    )
    decided = (
        marked.groupBy("component")
        .agg(F.max(F.col("_own") == "allow").alias("_allow"), F.max(F.col("_own") == "block").alias("_block"))
        .select(
            F.col("component").alias("_class"),
            F.when(F.coalesce("_block", F.lit(False)) & ~F.coalesce("_allow", F.lit(False)), "block").otherwise("allow").alias("_shared"),
        )
    )
    shared = marked.join(decided, F.col("component") == F.col("_class")).select("url", "component", "_shared")
    return judged.join(shared, "url", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_shared", F.lit("allow")).alias("verdict"),
        F.col("component").alias("url_class"),
    )
