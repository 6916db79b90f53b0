"""Per-query inputs in two layers.

*Name layer* (``names``, ``ledger_names``): what a script's file name and the
ledger's own columns tell.  It is lazy, so Catalyst prunes the script text from
the scan of every query that does not look at it.

*Text layer* (``parsed``, ``keys``, ``ledger``): what comes from reading and
splitting the script text (checksum, rollback flag, line count, preview).  The
narrow result is frozen once per query with a reliable checkpoint in the shared
folder, and every branch of the query reads that instead of the text.  The memo
belongs to one run of one registered query and to its session.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scripts as fs
from ..operators import corpus as cp
from ..operators.scan import freeze
from ..sources import bindings as b

_RUN: ContextVar[dict | None] = ContextVar("inputs_of_this_run", default=None)


def clear() -> None:
    """Start a new run: nothing frozen before is used again."""
    _RUN.set({})
    b.new_run()


def _once(key: tuple, make) -> DataFrame:
    memo = _RUN.get()
    if memo is None:
        return make()
    if key not in memo:
        memo[key] = make()
    return memo[key]


def names(spark: SparkSession, d: str) -> DataFrame:
    """The name layer of the corpus (all files, invalid names too); no text."""
    return cp.parse_names(b.scripts(spark, d)).select("doc_id", *cp.NAME_COLUMNS)


def valid_names(spark: SparkSession, d: str) -> DataFrame:
    return cp.valid_scripts(names(spark, d))


def ledger_names(spark: SparkSession, d: str) -> DataFrame:
    """B2, lazy: a query that leaves the checksum alone reads no text."""
    return b.ledger(spark, d)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    """The parsed corpus, narrow and frozen (all files, invalid names too)."""
    def make():
        p = cp.parse_scripts(b.scripts(spark, d))
        return freeze(p.select(
            "doc_id", *cp.KEY_COLUMNS, "marker_style",
            F.md5(F.concat(F.col("checksum"), F.lit("x"))).alias("checksum_edited"),
            fs.preview("up_sql").alias("preview"), (F.col("line_count") > fs.PREVIEW_LINES).alias("preview_more")))
    return _once(("parsed", d), make)


def keys(spark: SparkSession, d: str) -> DataFrame:
    """Valid scripts, narrow key columns (+ doc_id), text layer."""
    return cp.valid_scripts(parsed(spark, d)).select("doc_id", *cp.KEY_COLUMNS)


def ledger(spark: SparkSession, d: str) -> DataFrame:
    """B2 over the frozen parse."""
    return b.ledger(spark, d, parsed(spark, d))


def baselines(spark: SparkSession, d: str) -> DataFrame:
    """Only the baseline rows of B2 (no parse needed)."""
    return b.ledger_baselines(spark, d)


def ddl(spark: SparkSession, d: str) -> DataFrame:
    """DDL object names of the corpus, extracted in one pass and frozen."""
    from ..operators.catalog import ddl_objects
    return _once(("ddl", d), lambda: freeze(ddl_objects(b.scripts(spark, d))))
