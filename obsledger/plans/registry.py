"""Registry of the runnable queries and, next to each, the SQL it is checked against."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.plans.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(
    name: str, sql: str | None = None, views: dict[str, str] | None = None, dates: Sequence[str] = ()
) -> Callable[[Query], Query]:
    """Register a query; `sql` may use the fixture views, which are put in front of it.

    The `dates` columns are given as text on both sides, so that they compare alike
    whatever date type a client makes of them. The function itself stays as it is.
    """

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = _with_text_dates(fn, dates) if dates else fn
        if sql is not None:
            full = with_views(sql, views)
            if dates:
                texts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
                full = f"SELECT * REPLACE ({texts}) FROM (\n{full}\n)"
            ORACLES[name] = full
        return fn

    return register


def _with_text_dates(fn: Query, dates: Sequence[str]) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir).withColumns({d: F.col(d).cast("string") for d in dates})

    return run
