"""Script names and text: P1-P12 on hand-made rows (reference test cases)."""

from pyspark.sql import functions as F

from ledgerfleet.functions import scripts as fs
from ledgerfleet.operators import corpus as cp


def parse(spark, rows):
    df = spark.createDataFrame(rows, "target_id string, path string, body string")
    return {r["path"]: r for r in cp.parse_scripts(df).collect()}


def test_kinds_and_names(spark):
    rows = [("t", p, "SELECT 1;") for p in
            ["0001_init.sql", "R__views.sql", "R_.sql", "R__", "R_test.sql", "+5_plus.sql", "12345_big.sql",
             "4294967295_max.sql", "4294967296_over.sql", "abc_x.sql", "7.sql", "0_zero.sql", "03_a_b.sql"]]
    got = parse(spark, rows)
    assert got["0001_init.sql"]["kind"] == "versioned" and got["0001_init.sql"]["version"] == 1
    assert got["0001_init.sql"]["identifier"] == "1" and got["0001_init.sql"]["filename"] == "0001_init.sql"
    assert got["R__views.sql"]["kind"] == "repeatable" and got["R__views.sql"]["identifier"] == "R__views"
    for bad in ["R_.sql", "R__", "R_test.sql", "4294967296_over.sql", "abc_x.sql", "7.sql"]:
        assert got[bad]["kind"] == "invalid", bad
    assert got["+5_plus.sql"]["version"] == 5 and got["+5_plus.sql"]["filename"] == "0005_plus.sql"
    # 5 digits are kept, not cut to 4
    assert got["12345_big.sql"]["filename"] == "12345_big.sql"
    assert got["4294967295_max.sql"]["kind"] == "versioned"
    assert got["0_zero.sql"]["version"] == 0
    assert got["03_a_b.sql"]["name"] == "a_b"


def test_marker_styles(spark):
    rows = [
        ("t", "1_a.sql", "-- +migrate Up\nCREATE TABLE a;\n-- +migrate Down\nDROP TABLE a;"),
        ("t", "2_b.sql", "  -- UP\nCREATE TABLE b;\n\n-- DOWN\nDROP TABLE b;\n"),
        ("t", "3_c.sql", "-- +goose Up\nCREATE TABLE c;\n-- +goose Down\n"),
        ("t", "4_d.sql", "-- @@UP@@\nCREATE TABLE d;\n-- @@DOWN@@\nDROP TABLE d;"),
        ("t", "5_e.sql", "-- +MIGRATE UP\n\n  CREATE TABLE e;  \n-- +Migrate down\n  DROP TABLE e;  "),
        ("t", "6_f.sql", "CREATE TABLE f;"),
        ("t", "7_g.sql", "-- +migrate Up\nCREATE TABLE g;"),
        ("t", "8_h.sql", "-- DOWN\nx\n-- UP\ny"),                   # Down before Up: no split
        ("t", "9_i.sql", "-- update the table\nSELECT 1;\n-- DOWN\nz"),  # Q3: '-- up' inside '-- update'
        ("t", "10_j.sql", "-- İİ -- +migrate Up\nA\n-- +migrate Down\nB"),  # Q4: non-ASCII before marker
    ]
    g = parse(spark, rows)
    assert (g["1_a.sql"]["marker_style"], g["1_a.sql"]["up_sql"], g["1_a.sql"]["down_sql"]) == \
        (1, "CREATE TABLE a;", "DROP TABLE a;")
    assert (g["2_b.sql"]["up_sql"], g["2_b.sql"]["down_sql"]) == ("CREATE TABLE b;", "DROP TABLE b;")
    assert g["3_c.sql"]["marker_style"] == 3 and g["3_c.sql"]["down_sql"] == ""
    assert not g["3_c.sql"]["has_rollback"] and g["1_a.sql"]["has_rollback"]
    assert g["4_d.sql"]["marker_style"] == 4
    assert (g["5_e.sql"]["up_sql"], g["5_e.sql"]["down_sql"]) == ("CREATE TABLE e;", "DROP TABLE e;")
    assert g["6_f.sql"]["marker_style"] == 0 and g["6_f.sql"]["down_sql"] is None
    assert g["7_g.sql"]["up_sql"] == "-- +migrate Up\nCREATE TABLE g;" and g["7_g.sql"]["down_sql"] is None
    assert g["8_h.sql"]["marker_style"] == 0
    assert g["9_i.sql"]["marker_style"] == 2 and g["9_i.sql"]["up_sql"] == "date the table\nSELECT 1;"
    assert (g["10_j.sql"]["up_sql"], g["10_j.sql"]["down_sql"]) == ("A", "B")


def test_split_is_linear(spark):
    """A 10 MB script of comments that look like Up markers, no Down marker."""
    import time
    line = "-- update the table, then -- +migrate up, -- +goose up and -- @@up@@ once more\n"
    body = line * (10_000_000 // len(line))
    df = spark.createDataFrame([("t", "1_a.sql", body), ("t", "2_b.sql", body + "-- +goose down\nX")],
                               "target_id string, path string, body string")
    t0 = time.time()
    got = {r.path: r for r in cp.parse_scripts(df).select("path", "marker_style", F.length("up_sql").alias("n"), "down_sql").collect()}
    assert time.time() - t0 < 20
    assert got["1_a.sql"].marker_style == 0 and got["1_a.sql"].n == len(body.strip())
    assert got["2_b.sql"].marker_style == 3 and got["2_b.sql"].down_sql == "X"


def test_first_up_without_a_later_down_ends_the_style(spark):
    g = parse(spark, [("t", "1_a.sql", "-- UP\nA\n-- +goose Up\nB\n-- +goose Down\nC"), ("t", "2_b.sql", "-- DOWN\n-- up x\n-- UP\ny\n-- down\n𝔘z"),
                      ("t", "3_c.sql", "-- +migrate up-- +migrate down")])
    assert (g["1_a.sql"]["marker_style"], g["1_a.sql"]["up_sql"], g["1_a.sql"]["down_sql"]) == (3, "B", "C")
    assert (g["2_b.sql"]["up_sql"], g["2_b.sql"]["down_sql"]) == ("x\n-- UP\ny", "𝔘z")
    assert (g["3_c.sql"]["up_sql"], g["3_c.sql"]["down_sql"], g["3_c.sql"]["has_rollback"]) == ("", "", False)


def test_checksum_covers_up_only(spark):
    rows = [("t", "1_a.sql", "-- UP\nX\n-- DOWN\nY"), ("t", "2_a.sql", "junk\n-- UP\nX\n-- DOWN\nZZZ")]
    g = parse(spark, rows)
    assert g["1_a.sql"]["checksum"] == g["2_a.sql"]["checksum"]  # Q1


def test_line_count_preview_statements(spark):
    df = spark.createDataFrame([("",), ("a",), ("a\n",), ("a\n\nb",), ("\n",)], "x string")
    got = [r[0] for r in df.select(fs.line_count("x")).collect()]
    assert got == [0, 1, 1, 3, 1]
    long = "x" * 70
    df = spark.createDataFrame([(f"l1\n\n{long}\r\nl4\nl5",)], "x string")
    r = df.select(fs.preview("x").alias("p"), fs.preview_truncated("x").alias("m")).first()
    assert r["p"] == "l1\n" + "x" * 60 and r["m"] is True
    df = spark.createDataFrame([("-- c\nCREATE TABLE a (x int);\n\n  INSERT INTO a\n VALUES (1); ;\n",)],
                               "x string")
    st = df.select(fs.statements("x").alias("s")).first()["s"]
    assert st == ["CREATE TABLE a (x int)", "INSERT INTO a VALUES (1)"]


def test_extract_objects(spark):
    df = spark.createDataFrame([("create table IF NOT EXISTS `Users` (x); DROP TABLE t1; CREATE INDEX idx_a ON t",)],
                               "x string")
    r = df.select(fs.extract_objects("x", "CREATE TABLE").alias("c"), fs.extract_objects("x", "DROP TABLE").alias("d"),
                  fs.extract_objects("x", "CREATE INDEX").alias("i")).first()
    assert (r["c"], r["d"], r["i"]) == (["users"], ["t1"], ["idx_a"])


def test_baseline_filename(spark):
    df = spark.createDataFrame([(3, "Initial Schema")], "v long, d string")
    assert df.select(fs.baseline_filename("v", "d")).first()[0] == "baseline_0003_initial_schema"


def test_invalid_names_rejected(spark):
    df = spark.createDataFrame([("t", "bad.sql", "x"), ("t", "1_ok.sql", "y")], "target_id string, path string, body string")
    rej = cp.invalid_names(cp.parse_scripts(df)).collect()
    assert [r["path"] for r in rej] == ["bad.sql"] and "invalid name format" in rej[0]["message"]
    assert cp.script_keys(cp.parse_scripts(df)).count() == 1
    assert F is not None
