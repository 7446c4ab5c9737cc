"""Every named query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from reelstats.plans.registry import load_all
from tests.conftest import SMALL_SF_DIR

ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SMALL_SF_DIR)
    rel = duck.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    want_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    want = Counter(tuple(_norm(r[c]) for c in cols) for r in want_rows)
    assert sum(got.values()) == sum(want.values())
    assert got == want


def test_every_query_is_registered_with_a_builder():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 60
    own = load_all()
    assert set(own) <= set(qs)
    assert all(q.oracle is not None for q in own.values())


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["userId", "movieId", "rating", "timestamp"]
    assert len(df.columns) == 18
    assert df.count() == 5065
