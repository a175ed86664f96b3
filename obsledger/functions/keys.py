"""Content-derived keys: the same row gets the same key in every run and on every executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(*columns: Column | str) -> Column:
    """MD5 over the columns' text, nulls taken as empty text, so null equals null."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def item_fingerprint(job: Column, kind: Column, path: Column, size: Column) -> Column:
    """SHA-256 over `job:kind:path:size`; a null part is empty text. It does not change once a hash is known."""
    return F.sha2(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in (job, kind, path, size)]), 256)
