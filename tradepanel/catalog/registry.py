"""Names of queries, their Spark functions and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

_runners: dict[str, Runner] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query; ``sql`` is the same result over the same tables."""

    def add(run: Runner) -> Runner:
        if name in _runners:
            raise ValueError(f"query {name} is registered twice")
        _runners[name] = run
        if sql is not None:
            _oracles[name] = sql
        return run

    return add


def _load() -> None:
    from tradepanel.catalog import (  # noqa: F401
        aggregates, dashboards, domain, features, forecasts, joins, models, projections, reshapes, scalars, scans,
        stored, windows,
    )


def runners() -> dict[str, Runner]:
    _load()
    return dict(_runners)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
