"""S1 / ST2: a data source of script trees whose files are listed by tasks.

``spark.read.text`` lists a fleet on the driver and keeps a status of every file
there.  This source plans with folder names alone: the driver lists the first
level of ``<root>/<target>/...``, deals its folders out, and the tasks walk them
one folder at a time.  What it returns is the listing (target_id, path, file,
bytes, modified), so queries on names open no file.

* ``targets`` and ``prefix`` limit what is walked: other folders are not opened.  They
  are options of the reader and not pushed-down filters, because Spark 4.1 keeps the
  filters pushed into a Python source with the frame: a second query on the same
  frame would run under the first one's (``tests/test_script_tree.py`` reuses one).
* ``read_bodies`` turns a listing into whole texts.  The files are dealt out by
  (target, path), so one target with a third of all files is read by many tasks,
  and a task hands on READ_BATCH bytes at a time.
* As a stream, an offset is a time: a batch holds the files modified after the
  last offset and up to the new one.  No list of files seen is kept, and a batch
  repeated after a failure takes the same range.  A file that is edited comes
  again; one that keeps an old modification time when it is moved in does not
  come (use ``streams.script_file_stream`` for such folders).  ``settle`` seconds
  are left out at the end of a range, for clocks that differ and files still
  being written.

A script is a file whose extension is exactly ``sql`` (a bare ``.sql`` has none);
names that start with ``_`` or ``.`` and empty files count, which Spark's text reader
leaves out.  A missing root is empty (S2).  Files are reached through ``pyarrow.fs`` (local, HDFS,
S3, GCS, ABFS); ``corpus.read_corpus`` reads any store Spark knows.
"""

from __future__ import annotations

import json
import re
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..operators.scan import freeze

# Readers and task functions travel by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "script_tree"
SCHEMA = "target_id string, path string, file string, bytes long, modified long"
LIST_TASKS = 200                # tasks that walk folders, unless the option 'tasks' says otherwise
LIST_BATCH = 10_000             # rows of a listing handed on at once
READ_BATCH = 16 << 20           # bytes of text handed on at once (a longer file stands alone)
READ_TASK = 64 << 20            # bytes of text a reading task gets


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``root`` and the path in it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", root) and not root.startswith("file://"):
        store, path = fs.FileSystem.from_uri(root)
        return store, path.rstrip("/")
    return fs.LocalFileSystem(), re.sub(r"^file:(//[^/]*)?", "", root).rstrip("/") or "/"


def is_script(name: str) -> bool:
    return name.endswith(".sql") and name != ".sql"


class Folders(InputPartition):
    """First-level folders of one task ('' stands for the files in the root)
    and the modification times it takes, start excluded, in nanoseconds."""

    def __init__(self, names: list[str], after: int = -1, until: int | None = None):
        super().__init__(names)
        self.names, self.after, self.until = names, after, until


class Tree:
    """Planning and walking, shared by the batch and the stream reader."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.tasks = int(options.get("tasks", LIST_TASKS))
        self.targets = set(json.loads(options["targets"])) if "targets" in options else None
        self.prefix = options.get("prefix", "")

    def asked(self, target: str) -> bool:
        return target.startswith(self.prefix) and (self.targets is None or target in self.targets)

    def leads(self, folder: str, tops: set[str] | None) -> bool:
        """Whether targets asked for may lie in a first-level folder."""
        top, deeper, _ = self.prefix.partition("/")
        return (tops is None or folder in tops) and (folder == top if deeper else folder.startswith(top))

    def planned(self, after: int = -1, until: int | None = None) -> list[Folders]:
        store, root = open_root(self.root)
        if store.get_file_info(root).type != fs.FileType.Directory:
            return [Folders([])]
        tops = None if self.targets is None else {t.split("/")[0] for t in self.targets}
        names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root))
                       if i.type == fs.FileType.Directory and self.leads(i.base_name, tops))
        names = [""] * self.asked("") + names
        n = max(1, min(self.tasks, len(names)))
        return [Folders(names[k::n], after, until) for k in range(n)]

    def walk(self, part: Folders) -> Iterator[pa.RecordBatch]:
        store, root = open_root(self.root)
        rows: list[tuple] = []
        for name in part.names:
            todo = [name]
            while todo:
                folder = todo.pop()
                here = f"{root.rstrip('/')}/{folder}".rstrip("/") or "/"
                for info in store.get_file_info(fs.FileSelector(here, allow_not_found=True)):
                    if info.type == fs.FileType.Directory:
                        if name:                    # the root's folders have tasks of their own
                            todo.append(f"{folder}/{info.base_name}")
                    elif is_script(info.base_name) and self.asked(folder):
                        at = info.mtime_ns or 0
                        if at > part.after and (part.until is None or at <= part.until):
                            rows.append((folder, info.base_name, info.path, info.size, at))
                    if len(rows) >= LIST_BATCH:
                        yield listed(rows)
                        rows = []
        if rows:
            yield listed(rows)


def listed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["target_id", "path", "file", "bytes", "modified"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.tree = Tree(options)

    def partitions(self):
        return self.tree.planned()

    def read(self, partition):
        return self.tree.walk(partition)


class TreeStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.tree = Tree(options)
        self.settle = float(options.get("settle", 5))

    def initialOffset(self):
        return {"until": -1}

    def latestOffset(self):
        return {"until": int((time.time() - self.settle) * 1e9)}

    def partitions(self, start, end):
        return self.tree.planned(after=start["until"], until=end["until"])

    def read(self, partition):
        return self.tree.walk(partition)


class ScriptTree(DataSource):
    """``format("script_tree")`` with the options path, tasks, targets (a JSON
    list), prefix and settle."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TreeReader(dict(self.options))

    def streamReader(self, schema):
        return TreeStreamReader(dict(self.options))


def list_scripts(spark: SparkSession, root: str, targets: list[str] | None = None, prefix: str = "",
                 tasks: int = LIST_TASKS) -> DataFrame:
    """The listing of ``root``: target_id, path, file, bytes, modified (ns); of
    ``targets`` alone, and of those that start with ``prefix``, where given."""
    spark.dataSource.register(ScriptTree)
    reader = spark.read.format(FORMAT).option("tasks", tasks).option("prefix", prefix)
    if targets is not None:
        reader = reader.option("targets", json.dumps(targets))
    return reader.load(root)


def stream_scripts(spark: SparkSession, root: str, settle: float = 5, read_tasks: int | None = None) -> DataFrame:
    """ST2: (target_id, path, body) of scripts as they are modified."""
    spark.dataSource.register(ScriptTree)
    files = spark.readStream.format(FORMAT).option("settle", settle).load(root)
    return _bodies(files, root, read_tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_bodies(files: DataFrame, root: str) -> DataFrame:
    """(target_id, path, body) of a listing of ``root``, which is frozen, so
    that the files counted are the files read."""
    own = freeze(files)
    total = own.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    return _bodies(own, root, max(1, min(total["n"], (total["bytes"] or 0) // READ_TASK + 1)))


def read_fleet(spark: SparkSession, root: str, targets: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The corpus under ``root`` through the tree source."""
    return read_bodies(list_scripts(spark, root, targets, prefix), root)


def _bodies(files: DataFrame, root: str, tasks: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_root(root)
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*held), (pa.string(), pa.string(), pa.binary()))],
                names=["target_id", "path", "content"])

        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(row["file"]) as f:
                    content = f.read()
                if held and size + len(content) > READ_BATCH:
                    yield packed()
                    held, size = [], 0
                held.append((row["target_id"], row["path"], content))
                size += len(content)
        if held:
            yield packed()

    dealt = files.select("target_id", "path", "file").repartition(tasks, "target_id", "path")
    return (dealt.mapInArrow(read, "target_id string, path string, content binary")
            .select("target_id", "path", F.col("content").cast("string").alias("body")))
