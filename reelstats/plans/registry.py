"""Named queries: key -> (Spark builder over an sf directory, DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    oracle: str | None  # None: not SQL-expressible, checked by invariants in tests
    check: str  # "sql" | "inv" | "rows"


REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None = None, check: str | None = None):
    def wrap(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = Query(key, fn, oracle, check or ("sql" if oracle else "rows"))
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from reelstats.plans import (  # noqa: F401
        explore_plans,
        prepare_plans,
        profile_plans,
        recommend_plans,
        serving_plans,
        sink_plans,
        stream_plans,
    )

    return REGISTRY
