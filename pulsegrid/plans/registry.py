"""Query registry: every registered query has a Spark plan and (when SQL can say it)
an independent DuckDB oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}
_HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        if headline:
            _HEADLINE.append(name)
        return fn

    return deco


def _load() -> None:
    # import for side effects: each module registers its queries
    from . import (q_corpus, q_coverage, q_metrics, q_panels, q_probes, q_ranges, q_signals, q_sources,  # noqa: F401
                   q_streams)  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def headline() -> list[str]:
    _load()
    return list(_HEADLINE)
