"""Every registered query against its SQL on the smallest data, and the shape of its plan."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry
from obsledger.plans import ORACLES, QUERIES  # the ledger's own; the optional part tests its own
from tests.compare import connect, differences

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    assert not [p for p in FORBIDDEN if p in plan.getvalue()]
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["job_id", "observations", "canonical", "duplicates"]
    assert df.count() > 0
