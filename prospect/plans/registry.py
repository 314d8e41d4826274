"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole given tables
(or data Spark derives from them). Column names match the oracle's so the driver can compare
them; ``None`` as SQL marks an operator that SQL cannot express (a fitted model, a stream),
checked by rows only here and by property tests in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from prospect.plans import (q_features, q_metrics, q_models, q_prep, q_sources, q_stats,  # noqa: F401
                                q_streaming)


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
