"""Session construction and the shared checkpoint folder.

Library code never invents a machine-local folder: everything that must
outlive a task (checkpoints, snapshots, stream state) goes under the folder
the cluster names in ``spark.checkpoint.dir``.  Only tests and the bench set
that value themselves, and only when it is unset.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on.  AQE re-plans joins from runtime
# statistics (runtime broadcast of small sides, skew-join splitting, partition
# coalescing); the session time zone is pinned so timestamp text is stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    # checkpoint files of frozen intermediate frames are removed once the
    # frame is garbage collected on the driver
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Inferred IS NOT NULL filters on join keys get pushed into the scan with
    # the key's whole derivation inlined (file-name parsing, Up/Down split,
    # checksum); that overflows the 64 KB codegen method limit and drops the
    # stage out of whole-stage codegen.  Join keys are non-null by
    # construction here, so the inferred filters buy nothing.
    "spark.sql.constraintPropagation.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "ledgerfleet",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster brings its own)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(k, BASE_CONF[k])
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a session without a local SparkContext (Spark Connect)
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    ``spark.checkpoint.dir`` wins.  ``fallback`` is only for tests/bench on a
    laptop, where the caller passes a fresh scratch folder.
    """
    sc = _context(spark)
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set at all
            conf_dir = None
    if sc is None:
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return conf_dir
    if not conf_dir:
        if fallback is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
        conf_dir = fallback
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state,
    snapshots written by the change operators)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, kind, uuid.uuid4().hex)


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run sized from the bytes a job reads (pass them
    to ``build_session(extra=...)`` or to spark-submit).

    Text is parsed in the scan stage; what follows moves narrow rows, about
    2 % of the text, so shuffle partitions hold 64 MB of those.  AQE joins
    small partitions and splits skewed ones."""
    narrow = max(input_bytes // 50, 1)
    return {
        "spark.sql.shuffle.partitions": str(max(cores * 2, narrow // (64 << 20) + 1)),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        # keyed state of ledger streams on disk, not on the executors' heaps
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
