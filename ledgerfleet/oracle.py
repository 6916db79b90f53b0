"""ANSI/DuckDB SQL twins of the registered queries (the correctness oracle).

Each oracle query is ``WITH <bindings it needs> SELECT ...`` over the driver's
pre-registered views.  The bindings are written once here as named CTEs with
their dependencies; ``sql(body, *needs)`` assembles the WITH clause.
"""

from __future__ import annotations

from .functions import scripts as fs

WS = fs.WHITESPACE
UP, LOW = fs.UPPER_ASCII, fs.LOWER_ASCII


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_ws(x: str) -> str:
    return f"trim({x}, {_lit(WS)})"


def strip_sfx(x: str, sfx: str) -> str:
    return f"(CASE WHEN suffix({x}, {_lit(sfx)}) THEN substr({x}, 1, length({x}) - {len(sfx)}) ELSE {x} END)"


def _split_cols() -> str:
    parts = []
    for i, (u, d) in enumerate(fs.MARKER_STYLES, start=1):
        parts.append(f"instr(lo, {_lit(u)}) AS u{i}")
        parts.append(f"CASE WHEN instr(lo, {_lit(u)}) > 0 THEN instr(substr(lo, instr(lo, {_lit(u)}) + {len(u)}), "
                     f"{_lit(d)}) ELSE 0 END AS d{i}")
    return ",\n      ".join(parts)


def _style() -> str:
    whens = " ".join(f"WHEN u{i} > 0 AND d{i} > 0 THEN {i}" for i in range(1, len(fs.MARKER_STYLES) + 1))
    return f"CASE {whens} ELSE 0 END"


def _up_down() -> tuple[str, str]:
    up = ["CASE marker_style"]
    down = ["CASE marker_style"]
    for i, (u, d) in enumerate(fs.MARKER_STYLES, start=1):
        start = f"(u{i} + {len(u)})"
        up.append(f"WHEN {i} THEN {trim_ws(f'substr(t, {start}, d{i} - 1)')}")
        down.append(f"WHEN {i} THEN {trim_ws(f'substr(t, {start} + d{i} - 1 + {len(d)})')}")
    up.append("ELSE t END")
    down.append("ELSE NULL END")
    return " ".join(up), " ".join(down)


def line_count_sql(x: str) -> str:
    return (f"(length({x}) - length(replace({x}, chr(10), '')) + "
            f"CASE WHEN {x} = '' OR suffix({x}, chr(10)) THEN 0 ELSE 1 END)")


def preview_sql(x: str) -> str:
    first = f"list_slice(string_split({x}, chr(10)), 1, {fs.PREVIEW_LINES})"
    no_cr = f"list_transform({first}, lambda s: {strip_sfx('s', chr(13))})"
    kept = f"list_filter({no_cr}, lambda s: {trim_ws('s')} <> '')"
    return f"array_to_string(list_transform({kept}, lambda s: substr(s, 1, {fs.PREVIEW_WIDTH})), chr(10))"


def statements_sql(x: str) -> str:
    lines = f"list_transform(string_split({x}, chr(10)), lambda s: {trim_ws('s')})"
    kept = f"list_filter({lines}, lambda s: NOT starts_with(s, '--') AND s <> '')"
    pieces = f"list_transform(string_split(array_to_string({kept}, ' '), ';'), lambda s: {trim_ws('s')})"
    return f"list_filter({pieces}, lambda s: s <> '')"


def ddl_regex(keyword: str) -> str:
    return fs.ddl_object_regex(keyword)


_UP_SQL, _DOWN_SQL = _up_down()

CTES: dict[str, tuple[list[str], str]] = {
    "scripts": ([], """
SELECT doc_id, source AS target_id,
  CASE WHEN doc_id % 23 = 0 THEN concat('notes-', CAST(doc_id AS VARCHAR), '.sql')
       WHEN doc_id % 50 = 10 THEN concat('R__views_', CAST(doc_id % 3 AS VARCHAR), '.sql')
       WHEN doc_id % 10 = 0 THEN concat('R__', lang, '_', CAST(doc_id AS VARCHAR), '.sql')
       ELSE concat(printf('%04d', CASE WHEN doc_id % 29 = 7 THEN doc_id // 400 * 400 + 1 ELSE doc_id + 1 END), '_', lang,
                   '_', CAST(doc_id AS VARCHAR), '.sql') END AS path,
  CASE doc_id % 6
    WHEN 0 THEN concat('-- +migrate Up', chr(10), text, chr(10), '-- +migrate Down', chr(10), 'DROP TABLE t', CAST(doc_id AS VARCHAR), ';')
    WHEN 1 THEN concat('-- UP', chr(10), text, chr(10), '-- DOWN', chr(10), 'DROP TABLE t', CAST(doc_id AS VARCHAR), ';')
    WHEN 2 THEN concat('-- +goose up', chr(10), text, chr(10), '-- +GOOSE Down', chr(10))
    WHEN 3 THEN concat('-- @@UP@@', chr(10), 'CREATE TABLE IF NOT EXISTS t', CAST(doc_id % 50 AS VARCHAR), ' (id INT);', chr(10), '-- comment', chr(10), 'DROP TABLE t', CAST(doc_id % 20 AS VARCHAR), ';', chr(10), 'CREATE INDEX IF NOT EXISTS ix', CAST(doc_id % 30 AS VARCHAR), ' ON t (id);', chr(10), text, chr(10), '-- @@DOWN@@', chr(10), 'DROP TABLE t', CAST(doc_id AS VARCHAR), ';')
    WHEN 4 THEN CASE WHEN doc_id % 12 = 4 THEN concat('-- Update of the table', chr(10), text, chr(10), '-- DOWN', chr(10), 'DROP TABLE t', CAST(doc_id AS VARCHAR), ';')
                ELSE concat('-- +migrate Up', chr(10), text) END
    ELSE text END AS body
FROM documents"""),
    "parsed_k": (["scripts"], f"""
SELECT *, CASE WHEN kind = 'versioned' THEN CAST(vnum AS VARCHAR)
               WHEN kind = 'repeatable' THEN 'R__' || name END AS identifier,
       CASE WHEN kind = 'versioned' THEN printf('%04d_%s.sql', vnum, name)
            WHEN kind = 'repeatable' THEN 'R__' || name || '.sql' END AS filename
FROM (
  SELECT *, CASE WHEN kind = 'repeatable' THEN {strip_sfx('substr(path, 4)', '.sql')}
                 WHEN kind = 'versioned' THEN {strip_sfx("substr(path, instr(path, '_') + 1)", '.sql')} END AS name
  FROM (
    SELECT *, CASE WHEN starts_with(path, 'R__') AND suffix(path, '.sql') THEN 'repeatable'
                   WHEN vnum0 IS NOT NULL AND vnum0 <= {fs.U32_MAX} THEN 'versioned' ELSE 'invalid' END AS kind,
              CASE WHEN NOT (starts_with(path, 'R__') AND suffix(path, '.sql')) AND vnum0 <= {fs.U32_MAX}
                   THEN vnum0 END AS vnum
    FROM (
      SELECT *, CASE WHEN instr(path, '_') > 0 AND regexp_matches(split_part(path, '_', 1), '^\\+?[0-9]+$')
                     THEN try_cast(split_part(path, '_', 1) AS BIGINT) END AS vnum0
      FROM scripts)))"""),
    "parsed": (["parsed_k"], f"""
SELECT doc_id, target_id, path, body, kind, vnum AS version, name, filename, identifier, marker_style,
       up_sql, down_sql,
       down_sql IS NOT NULL AND {trim_ws('down_sql')} <> '' AS has_rollback,
       md5(up_sql) AS checksum, CAST({line_count_sql('up_sql')} AS BIGINT) AS line_count
FROM (
  SELECT *, {_UP_SQL} AS up_sql, {_DOWN_SQL} AS down_sql
  FROM (
    SELECT *, {_style()} AS marker_style
    FROM (
      SELECT *,
      {_split_cols()}
      FROM (SELECT *, translate(t, {_lit(UP)}, {_lit(LOW)}) AS lo
            FROM (SELECT *, {trim_ws('body')} AS t FROM parsed_k)))))"""),
    "skeys": (["parsed"], """
SELECT doc_id, target_id, path, kind, version, name, filename, identifier, checksum, has_rollback, line_count
FROM parsed WHERE kind <> 'invalid'"""),
    "ledger_runs": (["parsed"], """
SELECT p.target_id,
  CASE WHEN p.doc_id % 19 = 0 THEN concat('orphan_', CAST(p.doc_id AS VARCHAR))
       WHEN starts_with(p.path, 'R__') THEN replace(p.path, '.sql', '')
       ELSE CAST(p.doc_id + 1 AS VARCHAR) END AS migration_id,
  CASE WHEN starts_with(p.path, 'R__') THEN 'repeatable' ELSE 'versioned' END AS migration_type,
  CASE WHEN starts_with(p.path, 'R__') THEN NULL WHEN p.doc_id % 19 = 0 THEN p.doc_id + 1000001
       ELSE p.doc_id + 1 END AS version,
  p.path AS filename,
  CASE WHEN l.toxic = 1 THEN md5(concat(md5(p.up_sql), 'x')) ELSE md5(p.up_sql) END AS checksum,
  e.ts AS applied_at, CAST(floor(e.value * 10) AS BIGINT) AS execution_time_ms, l.quality = 1 AS success
FROM parsed p JOIN labels l ON p.doc_id = l.doc_id JOIN events e ON e.event_id = p.doc_id
WHERE p.doc_id % 23 <> 0"""),
    "ledger": (["ledger_runs"], """
SELECT * FROM ledger_runs
UNION ALL
SELECT target_id, migration_id, migration_type, version, filename, checksum, applied_at - INTERVAL 1 HOUR,
  execution_time_ms, false FROM ledger_runs WHERE coalesce(version, 0) % 9 = 1
UNION ALL
SELECT source, CAST(min(doc_id) + 100 AS VARCHAR), 'baseline', min(doc_id) + 100, concat('baseline_', source),
  'baseline', CAST('2024-01-01 00:00:00' AS TIMESTAMP), CAST(0 AS BIGINT), TRUE
FROM documents GROUP BY source
UNION ALL
SELECT DISTINCT source, '50000000', 'baseline', CAST(50000000 AS BIGINT), concat('baseline_', source),
  'baseline', CAST('2024-01-01 00:00:00' AS TIMESTAMP), CAST(0 AS BIGINT), TRUE
FROM documents WHERE source = 'src2'"""),
    "targets": ([], "SELECT DISTINCT source AS target_id FROM documents UNION SELECT 'idle'"),
    # the latest row of each id; a baseline is not a run
    "lrun": (["ledger"], """
SELECT target_id, migration_id, migration_type, version, filename, checksum, applied_at, execution_time_ms, success
FROM (SELECT *, row_number() OVER (PARTITION BY target_id, migration_id ORDER BY applied_at DESC, success DESC,
        execution_time_ms DESC, filename) AS rn FROM ledger WHERE migration_type <> 'baseline') WHERE rn = 1"""),
    "baselines": (["ledger"], """
SELECT target_id, max(version) AS baseline_version FROM ledger WHERE migration_type = 'baseline' GROUP BY target_id"""),
    "seq": ([], """
SELECT conv_id AS target_id, turn + 1 AS version FROM conversations WHERE (conv_id * 7 + turn) % 11 <> 0
UNION ALL
SELECT conv_id, turn + 1 FROM conversations WHERE (conv_id + turn) % 13 = 0"""),
    "ledger_log": ([], """
SELECT user_id AS target_id, event_id % 40 AS version, event_id, ts,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' WHEN 'view' THEN 'remove' ELSE 'start' END AS op,
  CAST(floor(value * 10) AS INT) AS ms
FROM events"""),
    "changes": ([], """
SELECT CAST(t AS BIGINT) AS target_id, event_id + 1 AS version,
  CASE WHEN op = 'insert' AND (t % 2 = 0 OR event_id % 10 <> 5) THEN 100000000 + event_id * 50 + t
       ELSE (user_id * 7) % 300 * 50 + t END AS o_orderkey, op,
  CASE WHEN t % 4 = 3 AND event_id % 101 = 3 THEN NULL ELSE value END AS value
FROM (SELECT event_id, user_id, user_id % 50 AS t, value,
        CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS op FROM events)"""),
    "order_rows": ([], """
SELECT CAST(o_orderkey % 50 AS BIGINT) AS target_id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority FROM orders
UNION ALL SELECT CAST((o_orderkey % 50 + 1) % 50 AS BIGINT), o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 7 = 0"""),
    "change_scripts": (["changes"], """
SELECT target_id, version, version % 211 <> 0 AS has_rollback FROM changes WHERE version % 499 <> 0"""),
    "gated": (["seq"], """
SELECT DISTINCT CAST(target_id * 3 AS BIGINT) AS target_id FROM (
  SELECT target_id, version, row_number() OVER (PARTITION BY target_id ORDER BY version) AS position FROM seq)
WHERE position <> version AND target_id * 3 < 50"""),
    "conns": ([], """
SELECT p_partkey AS conn_id, replace(replace(replace(CASE p_partkey % 25
   WHEN 0 THEN 'Driver=x; Host=h{key}; HTTPPath=/sql; AuthMech=3; PWD=p' WHEN 1 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11'
   WHEN 2 THEN 'postgresql://u@h/{brand}' WHEN 3 THEN 'Driver=MySQL ODBC;Server=s' WHEN 4 THEN 'dsn={type}'
   WHEN 5 THEN 'sqlite:///data/{key}.db' WHEN 6 THEN 'Driver=psqlODBC;Server=mysqlhost{key}'
   WHEN 7 THEN 'postgresql://h/mysql_{key}' WHEN 8 THEN 'Driver=SQLite3;Database=d' WHEN 9 THEN 'Driver=x;Host=h'
   WHEN 10 THEN 'Host=h;HTTPPath=/s' WHEN 11 THEN 'Driver=x;Host=h;HTTPPath=/s'
   WHEN 12 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=3' WHEN 13 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=0'
   WHEN 14 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=1;Auth_Client_ID=c'
   WHEN 15 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=2'
   WHEN 16 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=9{key}' WHEN 17 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=7'
   WHEN 18 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=2;PWD=p;PWD=q=r'
   WHEN 19 THEN 'Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=0;Auth_AccessToken=t' WHEN 20 THEN 'pg'
   WHEN 21 THEN 'mariadb' WHEN 22 THEN 'sqlite3' WHEN 23 THEN 'delta' ELSE 'unknown' END,
   '{key}', CAST(p_partkey AS VARCHAR)), '{brand}', p_brand), '{type}', p_type) AS conn
FROM part"""),
    "catalog": (["scripts"], f"""
SELECT target_id, CASE length(target_id) % 3 WHEN 0 THEN 'MySQL' WHEN 1 THEN 'SQLite' ELSE 'PostgreSQL' END AS dialect,
  schema_name, object_type, object_name, is_temporary FROM (
SELECT DISTINCT * FROM (
  SELECT target_id, 'public' AS schema_name, 'table' AS object_type, lower(o) AS object_name, FALSE AS is_temporary
  FROM (SELECT target_id, unnest(regexp_extract_all(body, {_lit(ddl_regex('CREATE TABLE'))}, 1)) AS o
        FROM scripts WHERE doc_id % 5 <> 0)
  UNION ALL SELECT target_id, 'public', 'index', lower(o), FALSE
  FROM (SELECT target_id, unnest(regexp_extract_all(body, {_lit(ddl_regex('CREATE INDEX'))}, 1)) AS o
        FROM scripts WHERE doc_id % 5 <> 0)
  UNION ALL SELECT source, 'public', 'table', 'schema_migrations', FALSE FROM documents
  UNION ALL SELECT source, 'public', 'table', 'pg_archive', FALSE FROM documents
  UNION ALL SELECT source, 'public', 'table', 'sqlite_stat1', FALSE FROM documents
  UNION ALL SELECT source, 'pg_catalog', 'table', 'pg_class', FALSE FROM documents
  UNION ALL SELECT source, 'information_schema', 'view', 'tables', FALSE FROM documents
  UNION ALL SELECT source, 'mysql', 'table', 'user', FALSE FROM documents
  UNION ALL SELECT source, 'public', 'view', concat('v_', lang), FALSE FROM documents
  UNION ALL SELECT source, 'public', 'sequence', concat('seq_', lang), FALSE FROM documents
  UNION ALL SELECT source, 'public', 'view', concat('tmp_', lang), TRUE FROM documents))"""),
}


def sql(body: str, *needs: str, local: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the named bindings (and what they depend on), then the
    query's own ``local`` CTEs, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [(n, CTES[n][1]) for n in order] + list(local or [])
    if not parts:
        return body.strip()
    withs = ",\n".join(f"{n} AS ({q.strip()})" for n, q in parts)
    return f"WITH {withs}\n{body.strip()}"
