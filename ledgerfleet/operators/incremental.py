"""J8 kept up to date: a reconciled table, changed by signed rows.

``reconcile`` joins the whole corpus with the whole ledger.  A fleet that asks
again after every deployment keeps the joined rows in a bucketed table
(``snapshots``) with the keys (target_id, migration_id) and hands each run only
what is new:

* ``scripts``: signed script rows (``sign`` +1 added, -1 removed; an edited script
  is one of each, see ``signed_difference``);
* ``ledger``: new ledger rows, in any order: a late row loses to a later run;
* ``removed``: ids whose ledger rows are gone (a rollback).

The run reads the buckets of these keys, joins the scripts and runs of these keys
alone and writes the difference between their old and new rows as signed rows.  A
change that changes nothing cancels out and touches no bucket.  The
table is the sum of all signed rows, and so is any count over it: every run adds one
event per (target, state) whose count moves, and ``state_counts`` sums them.

Repeated rows are counted, not folded: rows that occur n times have the sign n.  A run
that dies is repeated under its name, as for any other bucketed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reconcile as rc
from .snapshots import SnapshotTable

KEYS = ["target_id", "migration_id"]
SCRIPT = ["kind", "version", "filename", "checksum"]
# a ledger column and its name in the joined row
RUN = {"migration_type": "migration_type", "version": "l_version", "filename": "l_filename", "checksum": "stored_checksum",
       "applied_at": "applied_at", "execution_time_ms": "execution_time_ms", "success": "success"}
SCHEMA = ("target_id string, migration_id string, kind string, version long, filename string, checksum string, "
          "migration_type string, l_version long, l_filename string, stored_checksum string, "
          "applied_at timestamp_ntz, execution_time_ms long, success boolean")


def signed_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The signed rows that turn ``old`` into ``new`` (same columns)."""
    both = old.withColumn("sign", F.lit(-1)).unionByName(new.select(*old.columns).withColumn("sign", F.lit(1)))
    return both.groupBy(*old.columns).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def _add(rows: DataFrame, signed: DataFrame) -> DataFrame:
    """``rows`` after the signed rows."""
    columns = rows.columns
    total = (rows.withColumn("sign", F.lit(1).cast("long")).unionByName(signed.select(*columns, F.col("sign").cast("long")))
             .groupBy(*columns).agg(F.sum("sign").alias("sign")))
    return total.where("sign > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("sign")))).select(*columns)


def create(spark: SparkSession, root: str, buckets: int) -> SnapshotTable:
    """An empty reconciled table; the first run loads it."""
    return SnapshotTable.create(spark.createDataFrame([], SCHEMA), root, KEYS, buckets)


def _changed_rows(table: SnapshotTable, read, scripts: DataFrame, ledger: DataFrame, removed: DataFrame) -> DataFrame:
    """The signed difference of the joined rows of the changed keys."""
    keys = scripts.select(*KEYS).unionByName(ledger.select(*KEYS)).unionByName(removed.select(*KEYS)).distinct()
    old = read(table.touched(keys)).join(keys, KEYS, "left_semi")
    own = old.where(F.col("kind").isNotNull()).select(*KEYS, *SCRIPT)
    runs = (old.where(F.col("migration_type").isNotNull())
            .select(*KEYS, *[F.col(joined).alias(name) for name, joined in RUN.items()]).distinct()
            .join(removed.select(*KEYS).distinct(), KEYS, "left_anti"))
    now = _add(own, scripts).withColumnRenamed("migration_id", "identifier")
    return signed_difference(old, rc.joined(now, runs.unionByName(ledger.select(*runs.columns))).select(*old.columns))


def publish(table: SnapshotTable, run: str, scripts: DataFrame | None = None, ledger: DataFrame | None = None,
            removed: DataFrame | None = None) -> int:
    """One run over what is new; returns the snapshot."""
    spark = table.spark
    if scripts is None:
        scripts = spark.createDataFrame([], SCHEMA).select(*KEYS, *SCRIPT).withColumn("sign", F.lit(1))
    if ledger is None:
        ledger = spark.createDataFrame([], SCHEMA).select(*KEYS, *[F.col(j).alias(name) for name, j in RUN.items()])
    if removed is None:
        removed = spark.createDataFrame([], SCHEMA).select(*KEYS)
    return table.publish(
        run, lambda read: _changed_rows(table, read, scripts, rc.non_baseline(ledger), removed),
        rewrite=_add, touching=lambda rows: rows, events=_count_changes)


def _count_changes(rows: DataFrame) -> DataFrame:
    return (rc.with_state(rows, "sign").groupBy("target_id", "state").agg(F.sum("sign").alias("change"))
            .where("change <> 0"))


def reconciled(table: SnapshotTable, snapshot: int | None = None) -> DataFrame:
    """J8 as ``reconcile`` returns it, read from the table without a join."""
    return rc.with_state(table.read(snapshot))


def state_counts(table: SnapshotTable) -> DataFrame:
    """A2: rows per target and state, summed from the runs' events alone."""
    return (table.events().groupBy("target_id", "state").agg(F.sum("change").alias("n")).where("n <> 0"))
