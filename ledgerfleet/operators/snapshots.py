"""Tables in buckets, rewritten bucket by bucket and published run by run.

A table lives under one folder of the shared storage:

* ``meta``: its schema, keys and number of buckets;
* ``data/run=<run>/bucket=<k>``: the rows of the buckets that a run wrote; a row's
  bucket is a hash of its keys, so a changed key touches one bucket;
* ``snapshots/<n>``: one row per bucket that has rows: the run whose files hold it;
* ``status/<run>``, ``events/<run>``: what a run decided and its ledger events;
* ``commits/<run>``: one row, written last: the run is whole.

A run reads and writes only the buckets it touches; the others stay where they
are and the new snapshot points to them.  Readers go by the commits, so they see a
snapshot and the events of its run at the same moment, or neither.

A run may die after any step and be repeated under its name: a step that is whole
(its ``_SUCCESS`` mark is there) is read back, the first that is not is
written again over its remains.  What a run read is fixed by its first step, which
notes the snapshot it starts from.  One run at a time writes to a table; a run that
starts from a snapshot which another run has replaced is refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

MAX_BUCKETS = 65_536          # bucket numbers pass through the driver


def _whole(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def write_step(df: DataFrame, path: str, *partitions: str) -> None:
    """Write a step of a run over whatever an earlier try left."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        meta = spark.read.parquet(f"{self.root}/meta").first()
        self.schema = StructType.fromJson(json.loads(meta["schema"]))
        self.keys, self.buckets = list(meta["keys"]), meta["buckets"]

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: list[str], buckets: int) -> SnapshotTable:
        """Write ``df`` as snapshot 0."""
        if not 0 < buckets <= MAX_BUCKETS:
            raise ValueError(f"1 to {MAX_BUCKETS} buckets, not {buckets}")
        spark = df.sparkSession
        write_step(spark.createDataFrame([(df.schema.json(), keys, buckets)], "schema string, keys array<string>, buckets int"),
                   f"{root.rstrip('/')}/meta")
        table = cls(spark, root)
        table._write_data("create", df)
        table._write_snapshot("create", 0, table._own_buckets("create"))
        table._commit("create", 0)
        return table

    # --- reading -------------------------------------------------------------------------

    def snapshot(self) -> int:
        """The latest committed snapshot."""
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.root}/commits").agg(F.max("snapshot")).first()[0]

    def _places(self, snapshot: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/snapshots/{snapshot}")

    def read(self, snapshot: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a snapshot (the latest one), of all or of some buckets:
        only the folders of these are listed and read."""
        places = self._places(self.snapshot() if snapshot is None else snapshot).collect()      # at most one row a bucket
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.root}/data/run={p['run']}/bucket={p['bucket']}" for p in places if wanted is None or p["bucket"] in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        full = StructType([*self.schema.fields, StructField("run", StringType()), StructField("bucket", IntegerType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*self.schema.names)

    def events(self) -> DataFrame:
        """The ledger events of the committed runs that had some."""
        commits = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.root}/commits")
        runs = [r["run"] for r in commits.where("has_events").select("run").collect()]           # one row a run
        return self.spark.read.parquet(*[f"{self.root}/events/{run}" for run in runs])

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    # --- writing --------------------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write_data(self, run: str, df: DataFrame) -> None:
        rows = df.select(*self.schema.names, self._bucket())
        write_step(rows.repartition("bucket"), f"{self.root}/data/run={run}", "bucket")

    def _own_buckets(self, run: str) -> DataFrame:
        full = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        return (self.spark.read.schema(full).parquet(f"{self.root}/data/run={run}").select("bucket").distinct()
                .select("bucket", F.lit(run).alias("run")))

    def _write_snapshot(self, run: str, number: int, places: DataFrame) -> None:
        write_step(places.withColumn("by", F.lit(run)).coalesce(1), f"{self.root}/snapshots/{number}")

    def _commit(self, run: str, snapshot: int, has_events: bool = False) -> None:
        one = self.spark.createDataFrame([(run, snapshot, has_events)], "run string, snapshot int, has_events boolean")
        write_step(one.coalesce(1), f"{self.root}/commits/{run}")

    def _step(self, path: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not _whole(self.spark, path):
            write_step(make(), path)
        return self.spark.read.parquet(path)

    def publish(self, run: str, decide: Callable[[Callable[[list[int]], DataFrame]], DataFrame],
                rewrite: Callable[[DataFrame, DataFrame], DataFrame], touching: Callable[[DataFrame], DataFrame],
                events: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """One run, named ``run``; returns its snapshot.

        ``decide(read)`` makes the rows the run acts on; ``read(buckets)`` gives it
        the table before the run.  They are frozen first, so a repeated run
        acts on the same.  ``touching(rows)`` are those whose keys change;
        ``rewrite(part, rows)`` gives the new rows of the touched buckets from
        the old ones; ``events(rows)`` the ledger events."""
        at = f"{self.root}/{{}}/{run}"
        if _whole(self.spark, at.format("commits")):
            return self.spark.read.parquet(at.format("commits")).first()["snapshot"]
        parent = self._step(at.format("starts"), lambda: self.spark.createDataFrame(
            [(self.snapshot(),)], "parent int")).first()["parent"]
        number, before = parent + 1, lambda buckets: self.read(parent, buckets)
        rows = self._step(at.format("status"), lambda: decide(before))
        if not _whole(self.spark, f"{self.root}/snapshots/{number}"):
            changed = touching(rows)
            buckets = self.touched(changed)
            if not _whole(self.spark, f"{self.root}/data/run={run}"):
                self._write_data(run, rewrite(before(buckets), rows))
            kept = self._places(parent).select("bucket", "run").where(~F.col("bucket").isin(buckets) if buckets else F.lit(True))
            self._write_snapshot(run, number, kept.unionByName(self._own_buckets(run)))
        owner = self._places(number).select("by").first()
        if owner is not None and owner["by"] != run:
            raise RuntimeError(f"run {run} started from snapshot {parent}, which run {owner['by']} has replaced")
        if events is not None:
            self._step(at.format("events"), lambda: events(rows).withColumn("snapshot", F.lit(number)).withColumn("run", F.lit(run)))
        self._commit(run, number, events is not None)
        return number
