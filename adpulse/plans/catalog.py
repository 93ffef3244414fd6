"""Registry of the pipeline's queries over the driver's tables.

Every entry maps a name to ``fn(spark, sf_dir) -> DataFrame`` and, where the
result is expressible in SQL, to an independent DuckDB statement over the same
parquet views that states the reference's semantics directly (the oracle).
The entries themselves live in the ``q_*`` modules of this package.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules fills the registry.
    from adpulse.plans import q_drift, q_ingest, q_mart, q_monthly, q_periods, q_scopes, q_stream, q_synthetic  # noqa: F401
