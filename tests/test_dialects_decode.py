"""Dialect resolution / detection, connection strings, text decoding."""

import datetime as dt

from ledgerfleet.functions import decode as dc
from ledgerfleet.functions import dialects as dl


def test_resolve(spark):
    df = spark.createDataFrame([("PostgreSQL",), ("pg",), ("mariadb",), ("Postgres",), ("x",)], "r string")
    assert [r[0] for r in df.select(dl.resolve("r")).collect()] == ["PostgreSQL", "PostgreSQL", "MySQL", "Generic",
                                                                     "Generic"]


def test_detect_and_best(spark):
    conns = ["postgresql://u@h/db", "PostgreSQL Unicode", "mysql://h", "sqlite:///x.db", "dsn=foo",
             "postgres and mysql", "Driver=SQLite3 ODBC"]
    df = spark.createDataFrame([(c,) for c in conns], "c string")
    bm = dl.best_match(dl.candidates("c"))
    out = df.select("c", *[v.alias(k) for k, v in bm.items()]).collect()
    got = {r.c: (r.dialect, r.confidence_pct, r.status) for r in out}
    assert got["postgresql://u@h/db"] == ("PostgreSQL", 90, "OK")
    assert got["PostgreSQL Unicode"] == ("PostgreSQL", 90, "OK")      # lower-cased '.*postgres.*' wins
    assert got["mysql://h"] == ("MySQL", 90, "OK")
    assert got["sqlite:///x.db"] == ("SQLite", 90, "OK")
    assert got["dsn=foo"] == ("Generic", 10, "OK")
    assert got["postgres and mysql"][2] == "AMBIGUOUS"
    amb = [r.message for r in out if r.c == "postgres and mysql"][0]
    assert amb == 'Multiple dialects detected: ["MySQL", "PostgreSQL", "Generic"]'


def test_key_values_and_rules(spark):
    rows = [("Driver=x;Host=h;HTTPPath=/p;AuthMech=3;PWD=t",), ("Driver=x;Host=h;HTTPPath=/p;AuthMech=3",),
            ("Driver=x;Host=h;HTTPPath=/p;AuthMech=11;Auth_Flow=1;Auth_Client_ID=a",),
            ("Driver=x;Host=h;HTTPPath=/p;AuthMech=11;Auth_Flow=7",), ("Host=h",),
            ("Driver=x;Host=h;HTTPPath=/p;AuthMech=2",), (" KEY = a=b ; key=c ; junk ;",)]
    df = spark.createDataFrame(rows, "c string")
    msgs = [r[0] for r in df.select(dl.validate_connection(dl.key_value_entries("c"))).collect()]
    assert msgs[0] is None
    assert msgs[1] == dl.MSG_PWD_AUTH3 and msgs[2] == dl.MSG_M2M
    assert msgs[3] == "Invalid Auth_Flow: 7" and msgs[4] == "Missing required parameter: driver"
    assert msgs[5] == "Unsupported AuthMech: 2"
    kv = df.where("c LIKE ' KEY%'").select(dl.key_value_entries("c").alias("e")).first()["e"]
    assert [(e["key"], e["value"]) for e in kv] == [("key", "c")]     # last wins; value cut at '='


def test_decoders(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05+02:00", "YES", "+7"), ("2024-01-02 03:04:05", "no", " 5"),
                                ("2024-01-02 03:04:05.25", "1", "2.5"), ("garbage", "NULL", "99999999999999999999")],
                               "t string, b string, i string")
    out = df.select(dc.decode_timestamp("t").alias("t"), dc.decode_boolean("b").alias("b"),
                    dc.decode_int_or_zero("i").alias("i")).collect()
    assert out[0].t == dt.datetime(2024, 1, 2, 1, 4, 5) and out[1].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert out[2].t == dt.datetime(2024, 1, 2, 3, 4, 5, 250000) and out[3].t is None
    assert [r.b for r in out] == [True, False, True, False]
    assert [r.i for r in out] == [7, 0, 0, 0]


def test_integer_ranges(spark):
    df = spark.createDataFrame([("-5",), ("4294967295",), ("4294967296",), ("2147483648",), ("-2147483648",)], "i string")
    out = df.select(dc.decode_int_or_zero("i").alias("v"), dc.decode_int_or_zero("i", dc.I32_MIN, dc.I32_MAX).alias("ms")).collect()
    assert [r.v for r in out] == [0, 4294967295, 0, 2147483648, 0]
    assert [r.ms for r in out] == [-5, 0, 0, 0, -2147483648]


def test_single_precision_tie(spark):
    """0.9 against 0.8 lies within 0.1 in single precision, 0.8 against 0.7 does not."""
    df = spark.createDataFrame([("Driver=psqlODBC;Server=mysqlhost",), ("postgresql://h/mysql",), ("postgresql://h/x",)], "c string")
    bm = dl.best_match(dl.candidates("c"))
    assert [r[0] for r in df.select(bm["status"]).collect()] == ["AMBIGUOUS", "AMBIGUOUS", "OK"]


def test_connection_strings_are_parsed_once(spark):
    """The pairs of a string are worked out once for all rules, and in about linear time."""
    df = spark.createDataFrame([(None,), ("",), ("=a;junk;;=",), ("B=1; a = x ;b=2;A==y;c",)], "c string")
    for got in (dl.key_value_entries("c"), dl.validate_connection(dl.key_value_entries("c"))):
        plan = df.select(got.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(c#") == 1
    rows = [r[0] and [tuple(e) for e in r[0]] for r in df.select(dl.key_value_entries("c")).collect()]
    assert rows == [None, [], [(4, "", "")], [(3, "b", "2"), (4, "a", "")]]
    assert [r[0] for r in df.select(dl.validate_connection(dl.key_value_entries("c"))).collect()] == [dl.MSG_MISSING % "driver"] * 4
    long = ";".join(f"k{i % 15000}={i}" for i in range(20000)) + ";Driver=x;Host=h;HTTPPath=/p;AuthMech=3;PWD=t;pwd=u"
    df = spark.createDataFrame([(long,)], "c string")
    e, m = df.select(dl.key_value_entries("c"), dl.validate_connection(dl.key_value_entries("c"))).first()
    assert m is None and [x["pos"] for x in e] == [*range(5001, 20005), 20006]
    assert [x["value"] for x in e][-16:] == [*(str(i) for i in range(19989, 20000)), "x", "h", "/p", "3", "u"]
