"""J10 over a table of patterns: which patterns a text matches, as a join.

Patterns are rows (dialect, rank, conf, label, regex, raw, literal).  ``literal`` is
a text every match must hold; its first GRAM characters are the pattern's key.  A
text emits its distinct grams, meets the patterns by key, and only these are
verified by their regex.  The work follows the patterns that may match and not the
size of the table, and a dialect is added as rows.

Grams no pattern has as its key never leave the scan: as long as there are at most
KNOWN_KEYS different keys they are a constant of the scan; beyond, the join drops them
(same rows, tested).  The join is an equality join, so AQE broadcasts the patterns
where their measured size is small and deals out both sides by key otherwise.
A pattern without a literal (``required_literal`` gives none) has the key '' and
is verified against every text.

Of the patterns of a dialect that match, the one of the smallest rank counts.  A
null or empty text gets the fallback alone.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dialects as dl

GRAM = 3                # characters of a key
KNOWN_KEYS = 10_000     # different keys that are a constant of the scan
PATTERN_SCHEMA = "dialect string, rank int, conf int, label string, regex string, raw boolean, literal string"


def required_literal(pattern: str) -> str | None:
    """The longest plain run every match of ``pattern`` holds, lower-cased; None
    if there is none of GRAM characters, or if the pattern has groups, classes,
    alternatives, escapes or a letter beyond ASCII, which are not looked into."""
    if re.search(r"[|()\[\]\\{}]", pattern) or not pattern.isascii():
        return None
    # a character before * or ? need not occur; + keeps it but ends the run
    runs = re.split(r"[.^$+]|[^*?+][*?][?+]?", re.sub(r"\.[*?+]+", ".", pattern))
    best = max((r for r in runs if not re.search(r"[*?]", r)), key=len, default="")
    return best.lower() if len(best) >= GRAM else None


def pattern_table(spark: SparkSession, specs: list[dict] | tuple[dict, ...] = dl.DIALECTS) -> DataFrame:
    """The patterns of dialect specifications as rows, in the order of their rules."""
    rows = []
    for spec in specs:
        if spec["detects"]:
            rules = [(dl.CONF_CONNECTION, p, p, False, required_literal(p)) for p in spec["connection"]]
            rules += [(dl.CONF_DRIVER, p, p, True, required_literal(p)) for p in spec["driver"]]
            rules += [(dl.CONF_SUBSTRING, spec["substring_label"], None, False, s) for s in spec["substrings"]]
            rows += [(spec["name"], rank, *rule) for rank, rule in enumerate(rules)]
    return spark.createDataFrame(rows, PATTERN_SCHEMA)


def detected(conns: DataFrame, patterns: DataFrame, key: str = "conn_id", text: str = "conn",
             known_keys: int = KNOWN_KEYS) -> DataFrame:
    """(key, name, conf, pattern): every dialect whose patterns match, and the
    fallback.  ``key`` is unique in ``conns``."""
    short = F.coalesce(F.length("literal"), F.lit(0)) < GRAM
    table = patterns.withColumn("gram", F.when(short, F.lit("")).otherwise(F.lower(F.left("literal", F.lit(GRAM)))))
    own = conns.select(F.col(key), F.col(text).alias("_text"))
    grams = F.concat(F.regexp_extract_all(F.lower("_text"), F.lit("(?s)(?=(.{%d}))" % GRAM), F.lit(1)), F.array(F.lit("")))
    keys = [r["gram"] for r in table.select("gram").distinct().limit(known_keys + 1).collect()]
    if len(keys) <= known_keys:
        grams = F.array_intersect(grams, F.from_json(F.lit(json.dumps(keys)), "array<string>"))
    met = own.select(key, "_text", F.explode(F.array_distinct(grams)).alias("gram")).join(table, "gram")
    low = F.lower("_text")
    hit = (F.when(F.col("regex").isNull(), F.contains(low, F.col("literal")))
           .otherwise(F.rlike(F.when(F.col("raw"), F.col("_text")).otherwise(low), F.col("regex"))))
    best = (met.where(hit).groupBy(key, "dialect").agg(F.min(F.struct("rank", "conf", "label")).alias("b"))
            .select(key, F.col("dialect").alias("name"), "b.conf", F.col("b.label").alias("pattern")))
    rest = conns.select(key, F.lit(dl.FALLBACK_DIALECT).alias("name"), F.lit(dl.CONF_FALLBACK).alias("conf"),
                        F.lit(dl.FALLBACK_LABEL).alias("pattern"))
    return best.unionByName(rest)


def best_matches(found: DataFrame, key: str = "conn_id") -> DataFrame:
    """W7 over ``detected``: a list per text holds one entry a dialect."""
    each = F.struct((-F.col("conf")).alias("neg_conf"), "name", "pattern")
    lists = found.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("cands"))
    return lists.select(key, *[v.alias(k) for k, v in dl.best_match("cands").items()])
