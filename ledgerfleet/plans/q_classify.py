"""Registered queries: dialect resolution, detection and connection-string
checks over B6 (J9, J10, W7, P22, F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..functions import dialects as dl
from ..operators import patterns as pt
from ..sources import bindings as b
from .registry import register


def conns(spark, d):
    return b.conns(spark, d)


def _duck_lit(s):
    return o._lit(s)


def _duck_detection_rows() -> str:
    """DuckDB twin of ``dialects.detection``: one row per matching dialect."""
    parts = []
    for spec in dl.DIALECTS:
        if not spec["detects"]:
            continue
        whens = []
        for p in spec["connection"]:
            whens.append((f"regexp_matches(lower(conn), {_duck_lit(p)})", dl.CONF_CONNECTION, p))
        for p in spec["driver"]:
            whens.append((f"regexp_matches(conn, {_duck_lit(p)})", dl.CONF_DRIVER, p))
        if spec["substrings"]:
            cond = " OR ".join(f"contains(lower(conn), {_duck_lit(s)})" for s in spec["substrings"])
            whens.append((f"({cond})", dl.CONF_SUBSTRING, spec["substring_label"]))
        conf = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v, _ in whens) + " END"
        pat = "CASE " + " ".join(f"WHEN {c} THEN {_duck_lit(p)}" for c, _, p in whens) + " END"
        parts.append(f"SELECT conn_id, {_duck_lit(spec['name'])} AS name, {conf} AS conf, {pat} AS pattern "
                     f"FROM conns")
    parts.append(f"SELECT conn_id, {_duck_lit(dl.FALLBACK_DIALECT)}, {dl.CONF_FALLBACK}, "
                 f"{_duck_lit(dl.FALLBACK_LABEL)} FROM conns")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE conf IS NOT NULL"


_CANDS = [("cands", _duck_detection_rows())]


@register("resolve_alias", o.sql(
    "SELECT conn_id, requested, CASE " + " ".join(
        f"WHEN requested = {_duck_lit(d['name'])} THEN {_duck_lit(d['name'])}" for d in dl.DIALECTS) + " "
    + " ".join(f"WHEN requested = {_duck_lit(a)} THEN {_duck_lit(d['name'])}" for d in dl.DIALECTS
               for a in d["aliases"])
    + f" ELSE {_duck_lit(dl.FALLBACK_DIALECT)} END AS dialect FROM (SELECT conn_id, "
    "regexp_extract(conn, '^([A-Za-z0-9]+)', 1) AS requested FROM conns)", "conns"))
def resolve_alias(spark, d):
    """The leading word of each connection string resolved as a dialect
    name, else as an alias, else Generic."""
    c = conns(spark, d).select("conn_id", F.regexp_extract("conn", r"^([A-Za-z0-9]+)", 1).alias("requested"))
    return c.select("conn_id", "requested", dl.resolve("requested").alias("dialect"))


@register("classify_pattern", o.sql(
    "SELECT conn_id, name, conf * 10 AS confidence_pct, pattern FROM cands", "conns", local=_CANDS))
def classify_pattern(spark, d):
    """Every dialect whose patterns match, with confidence and pattern,
    from the patterns as rows."""
    found = pt.detected(conns(spark, d), pt.pattern_table(spark))
    return found.select("conn_id", "name", (F.col("conf") * 10).alias("confidence_pct"), "pattern")


@register("best_match", o.sql(
    "SELECT conn_id, CASE WHEN NOT amb THEN name END AS dialect, CASE WHEN NOT amb THEN conf * 10 END "
    "AS confidence_pct, CASE WHEN NOT amb THEN pattern END AS matched_pattern, "
    "CASE WHEN amb THEN 'AMBIGUOUS' ELSE 'OK' END AS status, "
    "CASE WHEN amb THEN printf('Multiple dialects detected: [%s]', names) END AS message FROM ("
    "SELECT r.*, r.n > 1 AND (r.conf = r.conf2 OR (r.conf = 9 AND r.conf2 = 8)) AS amb FROM ("
    "SELECT conn_id, name, conf, pattern, "
    "row_number() OVER (PARTITION BY conn_id ORDER BY conf DESC, name) AS rk, "
    "lead(conf) OVER (PARTITION BY conn_id ORDER BY conf DESC, name) AS conf2, "
    "count(*) OVER (PARTITION BY conn_id) AS n, "
    "string_agg('\"' || name || '\"', ', ' ORDER BY conf DESC, name) OVER (PARTITION BY conn_id) AS names "
    "FROM cands) r WHERE rk = 1)", "conns", local=_CANDS))
def best_match(spark, d):
    """The detected dialect per connection string, or AMBIGUOUS."""
    c = conns(spark, d).select("conn_id", dl.candidates("conn").alias("cands"))
    bm = dl.best_match("cands")
    return c.select("conn_id", *[v.alias(k) for k, v in bm.items()])


_KEY_SQL = o.trim_ws("split_part(pair, '=', 1)")
_VALUE_SQL = o.trim_ws("split_part(pair, '=', 2)")
_KV = ("SELECT conn_id, key, arg_max(value, pos) AS value, max(pos) AS pos FROM ("
       f"SELECT conn_id, pos, lower({_KEY_SQL}) AS key, {_VALUE_SQL} AS value FROM ("
       "SELECT conn_id, unnest(generate_series(1, len(string_split(conn, ';')))) AS pos, "
       "unnest(string_split(conn, ';')) AS pair FROM conns) WHERE instr(pair, '=') > 0) GROUP BY conn_id, key")


@register("parse_key_values", o.sql(_KV, "conns"))
def parse_key_values(spark, d):
    """key/value pairs of every connection string (last key wins)."""
    c = conns(spark, d).select("conn_id", F.explode(dl.key_value_entries("conn")).alias("e"))
    return c.select("conn_id", "e.key", "e.value", "e.pos")


def _kv_get(k: str) -> str:
    return f"max(kv.value) FILTER (WHERE kv.key = '{k}') AS {k}"


@register("validate_key_values", o.sql(
    "SELECT conn_id, msg IS NULL AS valid, msg AS message FROM ("
    "SELECT conn_id, CASE "
    + " ".join(f"WHEN {k} IS NULL THEN '{dl.MSG_MISSING % k}'" for k in dl.REQUIRED_KEYS)
    + f" WHEN authmech IS NULL THEN '{dl.MSG_NO_AUTHMECH}'"
    f" WHEN authmech = '3' AND pwd IS NULL THEN '{dl.MSG_PWD_AUTH3}' WHEN authmech = '3' THEN NULL"
    f" WHEN authmech = '11' AND auth_flow IS NULL THEN '{dl.MSG_NO_FLOW}'"
    f" WHEN authmech = '11' AND auth_flow = '0' AND auth_accesstoken IS NULL THEN '{dl.MSG_TOKEN}'"
    f" WHEN authmech = '11' AND auth_flow = '1' AND (auth_client_id IS NULL OR auth_client_secret IS NULL) "
    f"THEN '{dl.MSG_M2M}'"
    f" WHEN authmech = '11' AND auth_flow = '2' AND pwd IS NULL THEN '{dl.MSG_U2M}'"
    f" WHEN authmech = '11' AND auth_flow NOT IN ('0', '1', '2') THEN printf('{dl.MSG_BAD_FLOW}', auth_flow)"
    f" WHEN authmech = '11' THEN NULL ELSE printf('{dl.MSG_BAD_AUTHMECH}', authmech) END AS msg FROM ("
    "SELECT c.conn_id, " + ", ".join(_kv_get(k) for k in ["driver", "host", "httppath", "authmech", "pwd",
                                                          "auth_flow", "auth_accesstoken", "auth_client_id",
                                                          "auth_client_secret"])
    + " FROM conns c LEFT JOIN kv ON kv.conn_id = c.conn_id GROUP BY c.conn_id))", "conns",
    local=[("kv", _KV)]))
def validate_key_values(spark, d):
    """F8: connection-string rules; the first broken rule's message."""
    c = conns(spark, d).select("conn_id", dl.validate_connection(dl.key_value_entries("conn")).alias("message"))
    return c.select("conn_id", F.col("message").isNull().alias("valid"), "message")
