"""Dialect resolution and detection as column expressions.

The reference matches a connection string against every registered
dialect's patterns in a loop.  The pattern lists are fixed configuration, so
here each dialect's detector is one ``CASE`` over ``rlike`` tests, evaluated
per row inside the scan -- no join against a pattern table, no shuffle.  A
registry with one more dialect is ``with_dialect(spec)``, passed as ``specs``; many
patterns, or patterns kept as rows, are met by ``operators/patterns.py``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scripts import wtrim

# --- fixed values: the dialect registry --------------------------------------------
# name, aliases, connection patterns (tested on the lower-cased string),
# driver patterns (tested on the raw string), plain substrings (lower-cased),
# and the label reported when a substring matched.  Databricks is registered
# but never detects (selection by configuration only); Generic always matches
# with confidence 0.1.
DIALECTS = (
    {"name": "PostgreSQL", "aliases": ["postgres", "postgresql", "pg"],
     "connection": ["postgresql://.*", "postgres://.*", ".*postgresql.*", ".*postgres.*"],
     "driver": ["PostgreSQL.*", "psqlODBC.*"],
     "substrings": ["postgresql", "postgres"], "substring_label": "postgresql|postgres", "detects": True},
    {"name": "MySQL", "aliases": ["mysql", "mariadb"],
     "connection": ["mysql://.*", ".*mysql.*", ".*mariadb.*"],
     "driver": ["MySQL.*", "MariaDB.*"],
     "substrings": ["mysql", "mariadb"], "substring_label": "mysql|mariadb", "detects": True},
    {"name": "SQLite", "aliases": ["sqlite", "sqlite3"],
     "connection": ["sqlite://.*", ".*sqlite.*"],
     "driver": ["SQLite.*", "SQLite3.*"],
     "substrings": ["sqlite"], "substring_label": "sqlite", "detects": True},
    {"name": "Databricks", "aliases": ["databricks", "spark", "delta"],
     "connection": [], "driver": [], "substrings": [], "substring_label": None, "detects": False},
    {"name": "Generic", "aliases": ["generic", "unknown"],
     "connection": [], "driver": [], "substrings": [], "substring_label": None, "detects": False},
)
FALLBACK_DIALECT = "Generic"
FALLBACK_LABEL = "fallback"
# confidences in tenths: connection pattern 0.9, driver pattern 0.8, substring 0.7, fallback 0.1
CONF_CONNECTION, CONF_DRIVER, CONF_SUBSTRING, CONF_FALLBACK = 9, 8, 7, 1
MSG_AMBIGUOUS = "Multiple dialects detected: [%s]"
# keys and rules of the connection-string check
REQUIRED_KEYS = ["driver", "host", "httppath"]
MSG_MISSING = "Missing required parameter: %s"
MSG_NO_AUTHMECH = "AuthMech parameter is required"
MSG_PWD_AUTH3 = "PWD (Personal Access Token) is required for AuthMech=3"
MSG_NO_FLOW = "Auth_Flow is required for OAuth authentication"
MSG_TOKEN = "Auth_AccessToken is required for OAuth token pass-through"
MSG_M2M = "Auth_Client_ID and Auth_Client_Secret are required for OAuth M2M"
MSG_U2M = "PWD is required for OAuth U2M"
MSG_BAD_FLOW = "Invalid Auth_Flow: %s"
MSG_BAD_AUTHMECH = "Unsupported AuthMech: %s"
# ------------------------------------------------------------------------------------


def with_dialect(spec: dict, specs: tuple[dict, ...] = DIALECTS) -> tuple[dict, ...]:
    """A registry with one more dialect (same keys as the entries of
    ``DIALECTS``); the fallback stays last."""
    return (*specs[:-1], spec, specs[-1])


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def resolve(requested, specs: tuple[dict, ...] = DIALECTS) -> Column:
    """A requested name resolves by exact dialect name, else by alias,
    else to the Generic fallback (names and aliases are case-sensitive)."""
    req = _c(requested)
    names = F.create_map(*[x for d in specs for x in (F.lit(d["name"]), F.lit(d["name"]))])
    aliases = F.create_map(*[x for d in specs for a in d["aliases"] for x in (F.lit(a), F.lit(d["name"]))])
    return F.coalesce(F.try_element_at(names, req), F.try_element_at(aliases, req), F.lit(FALLBACK_DIALECT))


def detection(conn, spec: dict) -> Column:
    """J10 for one dialect: struct(confidence tenths, matched pattern) or NULL."""
    conn = _c(conn)
    low = F.lower(conn)
    out = F.lit(None).cast("struct<conf:int,pattern:string>")
    rules = ([(low.rlike(p), CONF_CONNECTION, p) for p in spec["connection"]]
             + [(conn.rlike(p), CONF_DRIVER, p) for p in spec["driver"]])
    if spec["substrings"]:
        hit = F.lit(False)
        for s in spec["substrings"]:
            hit = hit | low.contains(s)
        rules.append((hit, CONF_SUBSTRING, spec["substring_label"]))
    for cond, conf, pat in reversed(rules):
        out = F.when(cond, F.struct(F.lit(conf).alias("conf"), F.lit(pat).alias("pattern"))).otherwise(out)
    return out


def candidates(conn, specs: tuple[dict, ...] = DIALECTS) -> Column:
    """All matching dialects as array<struct<neg_conf, name, pattern>>,
    best first (confidence desc, then name)."""
    items = []
    for d in specs:
        if d["detects"]:
            det = detection(conn, d)
            items.append(F.when(det.isNotNull(), F.struct((-det["conf"]).alias("neg_conf"),
                                                          F.lit(d["name"]).alias("name"),
                                                          det["pattern"].alias("pattern"))))
    items.append(F.struct(F.lit(-CONF_FALLBACK).alias("neg_conf"), F.lit(FALLBACK_DIALECT).alias("name"),
                          F.lit(FALLBACK_LABEL).alias("pattern")))
    return F.array_sort(F.filter(F.array(*items), lambda x: x.isNotNull()))


def best_match(cands) -> dict[str, Column]:
    """The top candidate unless the first two lie within 0.1 of each
    other, which is ambiguous.  Confidences are single-precision numbers, so
    0.9 against 0.8 (0.09999996 apart) is ambiguous and 0.8 against 0.7 is not."""
    cands = _c(cands)
    top, second = F.try_element_at(cands, F.lit(1)), F.try_element_at(cands, F.lit(2))
    def single(c):
        return (-c["neg_conf"] / F.lit(10)).cast("float")

    near = F.abs(single(top) - single(second)) < F.lit(0.1).cast("float")
    ambiguous = (F.size(cands) > 1) & near
    names = F.array_join(F.transform(cands, lambda x: F.concat(F.lit('"'), x["name"], F.lit('"'))), ", ")
    return {
        "dialect": F.when(~ambiguous, top["name"]),
        "confidence_pct": F.when(~ambiguous, -top["neg_conf"] * 10),
        "matched_pattern": F.when(~ambiguous, top["pattern"]),
        "status": F.when(ambiguous, F.lit("AMBIGUOUS")).otherwise(F.lit("OK")),
        "message": F.when(ambiguous, F.format_string(MSG_AMBIGUOUS, names)),
    }


def _bound(value: Column, use) -> Column:
    """``use`` of a value worked out once: every place where a column expression
    occurs is evaluated again, also for each element of a lambda around it."""
    return F.get(F.transform(F.array(value), use), 0)


def key_value_entries(conn) -> Column:
    """``k=v;k=v`` as array<struct<pos,key,value>>: pairs without '='
    dropped, key trimmed and lower-cased, value trimmed and cut at a second
    '=', later duplicates win (the earlier ones are dropped)."""
    pairs = F.filter(F.transform(F.split(_c(conn), ";"), lambda p, i: F.struct(p.alias("pair"), (i + 1).cast("long").alias("pos"))),
                     lambda x: F.instr(x["pair"], "=") > 0)
    entries = F.transform(pairs, lambda x: F.struct(
        F.lower(wtrim(F.substring_index(x["pair"], "=", 1))).alias("key"), x["pos"].alias("pos"),
        wtrim(F.get(F.split(x["pair"], "="), 1)).alias("value")))
    # by key and position, the last of a key has another key (or none) behind it
    last = _bound(F.array_sort(entries), lambda by_key: F.filter(
        by_key, lambda e, i: ~F.get(by_key, i + 1)["key"].eqNullSafe(e["key"])))
    return F.array_sort(F.transform(last, lambda e: F.struct(e["pos"].alias("pos"), e["key"].alias("key"),
                                                             e["value"].alias("value"))))


def validate_connection(entries) -> Column:
    """F8: the first broken rule's message, NULL when the string is valid."""
    needed = ["driver", "host", "httppath", "authmech", "pwd", "auth_flow", "auth_accesstoken", "auth_client_id", "auth_client_secret"]
    found = _bound(_c(entries), lambda e: F.struct(e["key"].alias("keys"), e["value"].alias("values")))
    values = _bound(found, lambda f: F.struct(*[
        F.get(f["values"], (F.array_position(f["keys"], k) - 1).cast("int")).alias(k) for k in needed]))
    return _bound(values, _first_broken_rule)


def _first_broken_rule(g: Column) -> Column:
    msg = None
    for k in REQUIRED_KEYS:
        cond, text = g[k].isNull(), F.lit(MSG_MISSING % k)
        msg = F.when(cond, text) if msg is None else msg.when(cond, text)
    am, flow = g["authmech"], g["auth_flow"]
    msg = (msg.when(am.isNull(), F.lit(MSG_NO_AUTHMECH))
           .when((am == "3") & g["pwd"].isNull(), F.lit(MSG_PWD_AUTH3))
           .when(am == "3", F.lit(None))
           .when((am == "11") & flow.isNull(), F.lit(MSG_NO_FLOW))
           .when((am == "11") & (flow == "0") & g["auth_accesstoken"].isNull(), F.lit(MSG_TOKEN))
           .when((am == "11") & (flow == "1") & (g["auth_client_id"].isNull() | g["auth_client_secret"].isNull()),
                 F.lit(MSG_M2M))
           .when((am == "11") & (flow == "2") & g["pwd"].isNull(), F.lit(MSG_U2M))
           .when((am == "11") & ~flow.isin("0", "1", "2"), F.format_string(MSG_BAD_FLOW, flow))
           .when(am == "11", F.lit(None))
           .otherwise(F.format_string(MSG_BAD_AUTHMECH, am)))
    return msg
