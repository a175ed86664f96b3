"""Cleaning of report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsledger.functions import values as V


def strip(text: Column) -> Column:
    """Without white space at both ends, in the Unicode sense."""
    return F.regexp_replace(text, f"^{V.WHITESPACE}+|{V.WHITESPACE}+$", "")


def file_name(path: Column) -> Column:
    """Last part of a path, trailing slashes ignored."""
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def sanitize_path(path: Column) -> Column:
    """Absolute paths are cut to their file name."""
    return F.when(path.startswith("/"), file_name(path)).otherwise(F.coalesce(path, F.lit("")))


def sanitize_detail(detail: Column) -> Column:
    """An absolute path behind the first `: ` is cut off with the colon."""
    return F.regexp_replace(F.coalesce(detail, F.lit("")), r"(?s)^((?:(?!: ).)*): /.*$", "$1")


def drop_internal_keys(metadata: Column) -> Column:
    """Metadata map without the keys that hold internal paths."""
    return F.map_filter(metadata, lambda k, v: ~k.isin(V.INTERNAL_KEYS))
