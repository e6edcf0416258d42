"""Registry of named queries over the driver's tables, each with a DuckDB twin.

A query is ``fn(spark, sf_dir) -> DataFrame``. The oracle is SQL text for
DuckDB with the base tables registered as views (fixture views are inlined as
CTEs with ``views.with_views``). Queries without a SQL twin (streams,
iterative jobs) are checked by rows only and by their own pytest goldens.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from sparksweep.plans import q_catalog, q_data, q_funcs, q_jobs, q_logs, q_stopping, q_stream, q_sweep  # noqa: F401
