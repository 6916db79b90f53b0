"""Fixed schemas of the relations the engine works on."""

from __future__ import annotations

from pyspark.sql import types as T

# Ledger: the reference's eight ledger columns plus the fleet key.
LEDGER_SCHEMA = T.StructType([
    T.StructField("target_id", T.StringType(), False),
    T.StructField("migration_id", T.StringType(), False),
    T.StructField("migration_type", T.StringType(), False),
    T.StructField("version", T.LongType(), True),
    T.StructField("filename", T.StringType(), False),
    T.StructField("checksum", T.StringType(), False),
    T.StructField("applied_at", T.TimestampNTZType(), True),
    T.StructField("execution_time_ms", T.LongType(), False),
    T.StructField("success", T.BooleanType(), False),
])

# The same ledger as text cells, as an external database hands it over
# (every cell a string, SQL NULL as the text 'NULL').
LEDGER_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType(), True)
                                   for f in LEDGER_SCHEMA.fields])

# Raw corpus: one record per script file.
CORPUS_SCHEMA = T.StructType([
    T.StructField("target_id", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("body", T.StringType(), True),
])

# Ledger event log (append-only form of the ledger, L1-L4).
LEDGER_EVENT_SCHEMA = T.StructType([
    T.StructField("target_id", T.StringType(), False),
    T.StructField("migration_id", T.StringType(), False),
    T.StructField("event_seq", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("op", T.StringType(), False),
    T.StructField("ms", T.LongType(), True),
])

FINDINGS_SCHEMA = T.StructType([
    T.StructField("target_id", T.StringType(), False),
    T.StructField("check", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("subject", T.StringType(), True),
    T.StructField("message", T.StringType(), False),
])

# Severity order used by the health verdict: Fail > Warn > Pass.
SEVERITY_RANK = {"PASS": 0, "WARN": 1, "FAIL": 2}

LEDGER_TABLE = "schema_migrations"
