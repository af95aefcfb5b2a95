"""Query registry: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator key, with the matching DuckDB oracle SQL where SQL can state it.

Every query reads the driver tables (or data Spark derives from them) in
full — no id subsets or row caps; a ``limit`` appears only where it is the
operator (sampling, top-k)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules populates the registry
    from marisnow.plans import q_cluster, q_export, q_images, q_sources, q_vectors  # noqa: F401


def _prepared(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from marisnow.session import ensure_checkpoint_dir, ship_package
        ship_package(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    """Registered queries; each first makes sure the Python workers can
    import this package and a checkpoint folder is configured."""
    _load_all()
    return {k: _prepared(f) for k, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
