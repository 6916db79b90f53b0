"""Registry of queries: one Spark plan and (where SQL can say it) one DuckDB
twin per operator of SURVEY section 2.  ``__spark_entry__`` exposes them.

Every query reads the driver's tables through the bindings, over whole tables
and whole texts.  Order-sensitive operators return an explicit position
column, since the oracle compares without order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from . import inputs
            inputs.clear()
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_catalog, q_changes, q_classify, q_corpus, q_ledger, q_reconcile, q_streaming  # noqa: F401
