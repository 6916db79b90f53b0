"""Read script files as whole texts, one record per file.

``spark.read.text(wholetext=True)`` keeps every file whole in one record, the
glob keeps files whose extension is exactly ``sql``, and ``recursiveFileLookup``
walks a fleet tree ``<root>/<target_id>/<file>.sql``.  Files are split across
tasks by Spark's file listing, so a large fleet reads in parallel.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CORPUS_SCHEMA


def read_corpus(spark: SparkSession, root: str, fleet: bool = True) -> DataFrame:
    """Return (target_id, path, body).  ``fleet=True`` takes target_id from
    the folder relative to ``root``; ``fleet=False`` reads one folder (target 'default'),
    non-recursively, like the reference loader."""
    if not _exists(spark, root):
        return absent_corpus(spark)  # S2
    reader = spark.read.option("pathGlobFilter", "*.sql")
    if fleet:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(root, wholetext=True)
    target, fname = target_and_name(root)
    # the glob also accepts a bare '.sql' (no stem); its extension is not 'sql'
    return (df.select((target if fleet else F.lit("default")).alias("target_id"), fname.alias("path"),
                      F.col("value").alias("body"))
            .where(F.col("path") != ".sql"))


def target_and_name(root: str) -> tuple[Column, Column]:
    """Target and file name of the file a row was read from.  The path Spark
    reports is URI-encoded (a space is %20): it is decoded, a literal '+' kept.
    The target is the folder relative to ``root``, so equal folder names under
    different parents stay apart; files right in ``root`` have target ''."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    inside = F.substring_index(path, base, -1) if base == "/" else F.when(
        F.instr(path, base) > 0, F.substr(path, F.instr(path, base) + F.lit(len(base)))).otherwise(path)
    return F.regexp_extract(inside, "^(?s)(.*)/[^/]*$", 1), F.substring_index(inside, "/", -1)


def absent_corpus(spark: SparkSession) -> DataFrame:
    """A missing folder is an empty corpus, not an error."""
    return spark.createDataFrame([], CORPUS_SCHEMA)


def folder_state(spark: SparkSession, root: str) -> tuple[str, str]:
    """'missing', 'file', 'folder' or 'unreadable' (with the reason)."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    try:
        store = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if not store.exists(path):
            return "missing", ""
        if store.getFileStatus(path).isFile():
            return "file", ""
        store.listStatus(path)
        return "folder", ""
    except Exception as why:      # a denied or broken listing
        return "unreadable", str(getattr(why, "java_exception", why)).splitlines()[0]


def _exists(spark: SparkSession, root: str) -> bool:
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(root)
        return bool(hpath.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hpath))
    except Exception:  # no local context to ask: let the reader decide
        return True
