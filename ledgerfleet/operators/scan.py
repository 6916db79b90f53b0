"""Ordered scans inside groups without putting a whole group in one task.

A window ``partitionBy(target_id)`` sends every row of a target to one task;
with a fleet where one target holds a third of all rows that task is the job.
The scans here give the same answer as such a window (row number, last
non-null value before a row) but split each group over many tasks:

1. ``repartitionByRange`` on (group, order) cuts the data into slices and
   sorts each; a hot group simply spans many slices.
2. Positions (``ordinal``): a row's place in its sorted slice is part of its
   ``monotonically_increasing_id``; less the group's first place in the slice it
   is the local position.  Last values (``last_before``): one window over
   (slice, group).
3. The summaries -- one row per (slice, group), about ``#slices + #groups``
   rows -- are scanned across slices to get each slice's carry-in, which is
   joined back.

The number of slices follows the data: at least the shuffle partitions, and
one per ``SLICE_ROWS`` rows of the input (or of a bound that the caller knows).

The slice id (``spark_partition_id`` after the range exchange) must be the
same for a row and for its slice summary.  Spark does not reuse an exchange
whose subtree holds a nondeterministic expression, and AQE may coalesce the
two reads differently, so the sliced rows are frozen once with a reliable
``checkpoint()`` into the shared checkpoint folder (``spark.checkpoint.dir``)
before the summary is taken.  Only the caller's narrow columns are written;
the checkpoint also cuts lineage, so a lost executor never re-slices.  Orders
must be total (add a unique tie-breaker) for the result to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_SLICE = "__slice"
SLICE_ROWS = 4_000_000


def freeze(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once, into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _sliced(df: DataFrame, group: list[str], order: list[Column], slices: int | None,
            at_most: int | None = None) -> DataFrame:
    """The frozen rows of ``df``, range-partitioned and sorted, with their
    slice and their id (ascending in a slice).  A checkpoint keeps its
    partitions, so the ids are read back, never made anew.  ``at_most``: a known
    upper bound of the rows, which then need not be counted."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if slices is None:
        n = max(n, -(-(df.count() if at_most is None else at_most) // SLICE_ROWS))
    keys = [*_cols(group), *order]
    own = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    frozen = freeze(own.withColumn("__id", F.monotonically_increasing_id()))
    return frozen.withColumn(_SLICE, F.shiftright("__id", 33))


def ordinal(df: DataFrame, group: list[str], order: list, name: str = "pos",
            slices: int | None = None, at_most: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its group, ordered
    by ``order`` (the result of ``row_number()`` over that window).  Pass
    ``at_most``, an upper bound of the rows, when the input is the result of joins:
    counting it would run them once more."""
    order = _cols(order)
    local = _sliced(df, group, order, slices, at_most)
    counts = local.groupBy(_SLICE, *group).agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(_SLICE, *group, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
                          .alias("__shift"))
    return (_with_carry(local, carry, group)
            .withColumn(name, (F.col("__id") + F.col("__shift") + 1).cast("long"))
            .drop("__id", "__shift", _SLICE))


def _with_carry(local: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    """Join the summaries back; a NULL in a group column matches a NULL."""
    names = [_SLICE, *group]
    renamed = carry.select(*[F.col(c).alias(f"__c_{k}") for k, c in enumerate(names)],
                           *[c for c in carry.columns if c not in names])
    same = [local[c].eqNullSafe(renamed[f"__c_{k}"]) for k, c in enumerate(names)]
    on = same[0]
    for cond in same[1:]:
        on = on & cond
    return local.join(renamed, on).drop(*[f"__c_{k}" for k in range(len(names))])


def last_before(df: DataFrame, group: list[str], order: list, value: str | list[str], name: str | list[str],
                slices: int | None = None) -> DataFrame:
    """Add ``name`` = the last non-null ``value`` among the rows of the same
    group that come strictly before this row (``last(value, ignorenulls)``
    over ``rowsBetween(unboundedPreceding, -1)``).  Lists give several values
    in one scan."""
    order = _cols(order)
    values, names = ([value], [name]) if isinstance(value, str) else (value, name)
    w = Window.partitionBy(_SLICE, *group).orderBy("__id")
    local = _sliced(df, group, order, slices)
    summary = local.groupBy(_SLICE, *group).agg(
        *[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col("__id"))).alias(f"__last{k}")
          for k, v in enumerate(values)])
    across = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(_SLICE, *group, *[F.last(f"__last{k}", ignorenulls=True).over(across).alias(f"__carry{k}")
                                             for k in range(len(values))])
    for k, v in enumerate(values):
        local = local.withColumn(f"__local{k}", F.last(v, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)))
    out = _with_carry(local, carry, group)
    for k, n in enumerate(names):
        out = out.withColumn(n, F.coalesce(f"__local{k}", f"__carry{k}"))
    return out.drop("__id", _SLICE, *[f"__{c}{k}" for c in ("local", "carry") for k in range(len(values))])


def any_before(df: DataFrame, group: list[str], order: list, flag: str, name: str,
               slices: int | None = None) -> DataFrame:
    """Add ``name`` = true when some earlier row of the group has ``flag``
    true (``max(flag)`` over ``rowsBetween(unboundedPreceding, -1)``)."""
    tmp = "__flag_mark"
    marked = df.withColumn(tmp, F.when(F.col(flag), F.lit(True)))
    out = last_before(marked, group, order, tmp, name, slices)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False))).drop(tmp)
