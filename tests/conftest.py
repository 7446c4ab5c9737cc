from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL_SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelstats.session import build_session

    session = build_session("local[*]", shuffle_partitions=8, app_name="reelstats-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from reelstats.sources.tables import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def rows(df, cols=None):
    """Rows of a DataFrame as sorted tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df, mode: str | None = None) -> str:
    """The physical plan as printed by `explain` (final once the DataFrame has run)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()
