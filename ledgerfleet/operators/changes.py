"""Versioned row changes folded onto a table, copy-on-write.

Parquet tables take no UPDATE / DELETE / MERGE, so a migration's row changes
are a DataFrame ``(target_id, version, <key>, op, value)`` with op in
{insert, update, delete}, and the new table is a transform of the old one,
written to a new snapshot path.

A row is known by (target_id, key): two targets of a fleet may hold the same
key in their own tables, so the base table carries ``target_id`` too.

Apply (R7), per target in version order, stops at the first failing change
(SURVEY Q25).  A change fails when a data check would reject it before the
write: an insert of a key that exists at that moment (primary key, M10), or a
NULL value for the NOT NULL column (M11).  Whether a key exists before a
change only depends on the key's earlier changes, so:

* ``exists_before`` = the key's last earlier insert/delete (skew-proof scan),
  else whether the base table has the key;
* the first failing version per target is a grouped ``min``;
* applied = before it, failed = it, blocked = after it;
* a target with sequence issues (``gate``) is not touched at all: its changes
  are blocked (SURVEY Q9).

The final state of a key is a grouped fold of its applied changes (no
ordering beyond ``max_by``, all buffers of fixed width): the last insert/delete
decides existence, the last change decides the value, and a key with only
updates keeps its base row (if any) with the new value.

Rollback (R9) validates first (SURVEY Q21): a target one of whose changes to
undo has no script, or a script without a Down section, is left as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import per_target_join
from .rollback import check_plan
from .scan import last_before
from .snapshots import SnapshotTable

OPS = ("insert", "update", "delete")
TARGET = "target_id"


def _code(op: str):
    """Operations as numbers, so that folds have buffers of a fixed width."""
    return F.when(F.col(op) == "insert", 0).when(F.col(op) == "update", 1).when(F.col(op) == "delete", 2)


def change_status(changes: DataFrame, base: DataFrame, key: str, value: str = "value",
                  gate: DataFrame | None = None) -> DataFrame:
    """Add ``prev_reset`` (the key's last insert or delete before), ``exists_before``,
    ``fails`` and ``status`` (applied / failed / blocked) to every change.  ``gate`` holds the target_ids whose scripts have
    sequence issues."""
    keys = [TARGET, key]
    # the ordered scan runs on the change rows alone (its sampling and
    # freezing jobs read nothing else); base existence is joined afterwards
    ch = changes.withColumn("_reset", F.when(F.col("op") != "update", F.col("op")))
    ch = last_before(ch, keys, [F.col("version")], "_reset", "_prev_reset")
    # one row per key on the base side: a plain join (a hot key on the change
    # side is split by AQE's skew join; salting would copy the whole table)
    base_keys = base.select(*keys).distinct().withColumn("_in_base", F.lit(True))
    ch = ch.join(base_keys, keys, "left")
    exists = (F.when(F.col("_prev_reset") == "insert", F.lit(True))
              .when(F.col("_prev_reset") == "delete", F.lit(False))
              .otherwise(F.coalesce(F.col("_in_base"), F.lit(False))))
    ch = ch.withColumn("exists_before", exists)
    fails = (((F.col("op") == "insert") & F.col("exists_before"))
             | (F.col("op").isin("insert", "update") & F.col(value).isNull()))
    ch = ch.withColumn("fails", fails).withColumnRenamed("_prev_reset", "prev_reset").drop("_reset", "_in_base")
    first = ch.where("fails").groupBy(TARGET).agg(F.min("version").alias("_first_fail"))
    if gate is not None:
        gated = gate.select(TARGET).distinct().withColumn("_gated", F.lit(True))
        first = first.join(gated, TARGET, "full_outer")
    else:
        first = first.withColumn("_gated", F.lit(False))
    ch = per_target_join(ch, first, [TARGET], "left", spread_by=["version"])
    status = (F.when(F.coalesce("_gated", F.lit(False)), F.lit("blocked"))
              .when(F.col("_first_fail").isNull() | (F.col("version") < F.col("_first_fail")), F.lit("applied"))
              .when(F.col("version") == F.col("_first_fail"), F.lit("failed")).otherwise(F.lit("blocked")))
    return ch.withColumn("status", status).drop("_first_fail", "_gated")


def fold_state(applied: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Final state per touched key from its applied changes: ``last_reset``
    (insert / delete / NULL when only updates) and ``last_value``."""
    reset_at = F.when(F.col("op") != "update", F.col("version"))
    last = F.max_by(_code("op"), reset_at)
    return (applied.groupBy(TARGET, key)
            .agg(last.alias("_r"), F.max_by(F.col(value), F.col("version")).alias("last_value"))
            .select(TARGET, key, F.when(F.col("_r") == 0, F.lit("insert")).when(F.col("_r") == 2, F.lit("delete"))
                    .alias("last_reset"), "last_value"))


def apply_to_table(base: DataFrame, state: DataFrame, key: str, set_col: str,
                   defaults: dict | None = None) -> DataFrame:
    """M2/M3/M4 in one copy-on-write pass: full outer join of the base table
    with the per-key state (both unique per key, so no skew)."""
    defaults = defaults or {}
    keys = [TARGET, key]
    j = base.withColumn("_b", F.lit(True)).join(state.withColumn("_s", F.lit(True)), keys, "full_outer")
    touched = F.col("_s").isNotNull()
    keep = (~touched
            | (F.col("last_reset") == "insert")
            | (F.col("last_reset").isNull() & F.col("_b").isNotNull()))
    out = j.where(keep)
    fresh = F.col("last_reset") == "insert"
    cols = []
    for f in base.schema.fields:
        c = f.name
        if c in keys:
            cols.append(F.col(c))
        elif c == set_col:
            cols.append(F.when(touched, F.col("last_value")).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            dflt = defaults.get(c)
            new_val = F.lit(dflt).cast(f.dataType) if dflt is not None else F.lit(None).cast(f.dataType)
            cols.append(F.when(touched & F.coalesce(fresh, F.lit(False)), new_val).otherwise(F.col(c)).alias(c))
    return out.select(*cols)


def apply_changes(base: DataFrame, changes: DataFrame, key: str, set_col: str, defaults: dict | None = None,
                  gate: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new table, change status)."""
    st = change_status(changes, base, key, gate=gate)
    applied = st.where(F.col("status") == "applied")
    return apply_to_table(base, fold_state(applied, key), key, set_col, defaults), st


def rollback_check(status: DataFrame, scripts: DataFrame, up_to_version: int) -> DataFrame:
    """R9 gate: the applied changes above the version, each with the check of
    its script (OK / NO_DOWN / MISSING_FILE), which names the file; ``scripts``
    has target_id, version, kind, path, has_rollback."""
    plan = (status.where((F.col("status") == "applied") & (F.col("version") > F.lit(up_to_version)))
            .select(TARGET, "version"))
    names = scripts.where(F.col("kind") == "versioned").groupBy(TARGET, "version").agg(F.min("path").alias("filename"))
    return check_plan(plan.join(names, [TARGET, "version"], "left"), scripts)


def validity(applied: DataFrame, key: str, value: str = "value") -> DataFrame:
    """The interval table of the applied changes: per change of a key
    the state it leaves (``last_reset``, ``last_value`` as ``fold_state`` has them)
    and the versions it holds for, ``valid_from`` to before ``valid_to`` (NULL: still).
    Any version of the table is a filter on it (``as_of``).  ``applied`` comes from
    ``change_status``, which tells the last insert or delete before each change.
    The next change of a key comes from the skew-proof scan, latest first, so a key with
    a third of all changes is no single task's."""
    rows = applied.select(TARGET, key, F.col("version").alias("valid_from"),
                          F.when(F.col("op") != "update", F.col("op")).otherwise(F.col("prev_reset")).alias("last_reset"),
                          F.col(value).alias("last_value"))
    return last_before(rows, [TARGET, key], [F.col("valid_from").desc()], "valid_from", "valid_to")


def as_of(intervals: DataFrame, version) -> DataFrame:
    """The state per touched key (as ``fold_state``) right after ``version``, a
    number or a column; NULL is the latest."""
    v = version if isinstance(version, Column) else F.lit(version).cast("long")
    holds = v.isNull() & F.col("valid_to").isNull()
    return intervals.where(F.coalesce(holds | ((F.col("valid_from") <= v) & (F.col("valid_to").isNull() | (F.col("valid_to") > v))),
                                      F.lit(False)))


def rollback_changes(base: DataFrame, status: DataFrame, scripts: DataFrame, key: str, set_col: str, up_to_version: int,
                     defaults: dict | None = None, intervals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(the table as of ``up_to_version``, the 'remove' events of the
    undone changes); targets whose rollback fails its check keep everything.
    ``intervals``: the interval table (``validity``), if it is kept already."""
    bad = (rollback_check(status, scripts, up_to_version).where(F.col("check_status") != "OK")
           .select(TARGET).distinct().withColumn("_bad", F.lit(True)))
    applied = status.where(F.col("status") == "applied")
    if intervals is None:
        intervals = validity(applied, key)
    held = per_target_join(intervals, bad, [TARGET], "left", spread_by=["valid_from"])
    state = as_of(held, F.when(F.col("_bad"), F.lit(None).cast("long")).otherwise(F.lit(up_to_version)))
    table = apply_to_table(base, state.select(TARGET, key, "last_reset", "last_value"), key, set_col, defaults)
    undone = per_target_join(applied.where(F.col("version") > F.lit(up_to_version)), bad, [TARGET], "left_anti",
                             spread_by=["version"])
    return table, undone.select(TARGET, "version", F.lit("remove").alias("op"))


def publish_changes(table: SnapshotTable, changes: DataFrame, key: str, set_col: str, run: str,
                    defaults: dict | None = None, at: str | None = None, gate: DataFrame | None = None) -> int:
    """R7 end to end on a table in buckets: the status of every change is
    frozen, the touched buckets alone are read and written, then the L1-L3 events
    follow and the run is committed.  A run that died is repeated under its
    name.  Returns the new snapshot."""
    keys = [TARGET, key]

    def status(before) -> DataFrame:
        return change_status(changes, before(table.touched(changes)).select(*keys), key, gate=gate)

    def applied(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("status") == "applied")

    stamp = F.lit(at).cast("timestamp_ntz") if at else F.localtimestamp()
    return table.publish(
        run, status, lambda part, rows: apply_to_table(part, fold_state(applied(rows), key), key, set_col, defaults), applied,
        lambda rows: ledger_events(rows).withColumn("ts", stamp))


def publish_updates(table: SnapshotTable, updates: DataFrame, set_col: str, run: str, value: str = "value") -> int:
    """M3 on a table in buckets: only buckets with an updated key are rewritten."""
    return table.publish(run, lambda before: updates, lambda part, rows: update_where(part, rows, table.keys, set_col, value),
                         lambda rows: rows)


def ledger_events(status: DataFrame) -> DataFrame:
    """L1-L3 out of R7: a start for every attempted change, then success or
    failure; blocked changes are not attempted."""
    tried = status.where(F.col("status") != "blocked")
    end = F.when(F.col("status") == "applied", F.lit("success")).otherwise(F.lit("failure"))
    return tried.select("target_id", "version", F.explode(F.array(F.lit("start"), end)).alias("op"))


def dry_run(status: DataFrame) -> DataFrame:
    """What R7 would do, counted per target, op and outcome."""
    return status.groupBy("target_id", "op", "status").agg(F.count(F.lit(1)).alias("changes"))


# --- single-purpose change operators ---------------------------------------------

def create_table(spark, name: str, schema, location: str) -> None:
    """M1: CREATE TABLE IF NOT EXISTS with ``schema`` (a StructType)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")


def replace_view(view: DataFrame, name: str) -> None:
    """M8: drop-and-recreate of a view."""
    view.createOrReplaceTempView(name)


def insert_rows(base: DataFrame, rows: DataFrame) -> DataFrame:
    """M2: append rows (columns by name; missing ones NULL)."""
    return base.unionByName(rows, allowMissingColumns=True)


def update_where(base: DataFrame, updates: DataFrame, keys: list[str], set_col: str, value: str = "value") -> DataFrame:
    """M3: set ``set_col`` where the key has an update (the latest one; a NULL
    is a value like any other)."""
    last = updates.groupBy(*keys).agg(F.max_by(F.col(value), F.col("version")).alias("_v")).withColumn("_hit", F.lit(True))
    j = base.join(last, keys, "left")
    new = F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(set_col)).cast(base.schema[set_col].dataType)
    return j.withColumn(set_col, new).drop("_v", "_hit")


def delete_where(base: DataFrame, cond) -> DataFrame:
    """M4: delete rows where ``cond`` is true; a NULL condition keeps the row."""
    return base.where(~F.coalesce(cond, F.lit(False)))


def add_column(base: DataFrame, name: str, dtype: str) -> DataFrame:
    """M7: a new nullable column."""
    return base.withColumn(name, F.lit(None).cast(dtype))


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """M9: column defaults where the value is missing."""
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
    return df


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that occur more than once (PRIMARY KEY / UNIQUE)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def check_not_null(df: DataFrame, table: str) -> DataFrame:
    """NULL count of every column, one aggregate pass, one row each."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, nulls)") \
        .select(F.lit(table).alias("table_name"), "column_name", F.col("nulls").cast("long").alias("nulls"))


def check_foreign_key(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key has no parent (AQE splits a hot key)."""
    return child.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """ON DELETE CASCADE: drop children of deleted parents."""
    return child.join(deleted_parents.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def child_counts(parent: DataFrame, child: DataFrame, pk: str, fk: str, name: str = "child_count") -> DataFrame:
    """Parent LEFT JOIN child, COUNT(child) per parent -- the children
    are counted per key first (map-side partial aggregation), so a parent
    with a third of all children never sits in one task."""
    per_key = child.groupBy(F.col(fk).alias(pk)).agg(F.count(F.lit(1)).alias(name))
    return (parent.join(per_key, pk, "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long")))
