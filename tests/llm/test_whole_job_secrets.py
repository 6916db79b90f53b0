"""Secrets in assignments without quotes, in URL queries, and short passwords."""

import pytest
from pyspark.sql import functions as F

from ledgerfleet.llm import secrets
from tests.llm.edge import documents, prose

KEY = "AbCdEf0123456789abcdXY"
CASES = [
    (f"API_KEY={KEY}", KEY), (f"see https://h/x?token={KEY}&page=2 there", KEY), (f"export MY_LONG_SECRET_API_KEY={KEY}\n", KEY),
    (f"https://h/x?a=1&token={KEY}", KEY), (f"AWS_SECRET_ACCESS_KEY={KEY}/K7MDENG==", f"{KEY}/K7MDENG=="),
    ("DB_PASSWORD=Tr0ub4!x", "Tr0ub4!x"), ("password: p@ss.w0rd~9, and more", "p@ss.w0rd~9"), ("PWD='h#9 $kq.2'", "h#9 $kq.2"),
    ('{"password": "q7!Zr$1"}', "q7!Zr$1"), ("dbPassword = hunter2", "hunter2"), ("SECRET_KEY_BASE=a&&b!c.&d", "a&&b!c.&d"),
    ("ö 𝒳 pwd=é!12345", "é!12345"), (f"x={KEY}", KEY), (f"QUJDREVGR0hJSktMTU5P=={KEY}", KEY)]


def test_secret_values_behind_an_assignment_are_candidates(spark):
    got = secrets.findings(documents(spark, [(k, t) for k, (t, _) in enumerate(CASES)])).collect()
    for k, (text, want) in enumerate(CASES):
        own = [r for r in got if r["doc_id"] == k]
        assert want in [r["token"] for r in own], (text, own)
        assert all(text[r["start"]:r["end"]] == r["token"] for r in own)
    names = {r["token"]: r["before"] for r in got if r["doc_id"] == 2}
    assert names[KEY].endswith("MY_LONG_SECRET_API_KEY=")
    # no credential: prose, other words, short values
    rest = secrets.findings(documents(spark, [(1, "the monkey: bananas"), (2, "key: abc"), (3, "token and secret words")]))
    assert rest.count() == 0


def test_secret_candidates_of_long_texts(spark):
    rows = [(1, "key=" + "a!" * 200_000), (2, "key=" + "&" * 200_000), (3, "key= " * 50_000), (4, "pwd=" + ".;" * 100_000)]
    got = {r["doc_id"]: (r["end"] - r["start"]) for r in secrets.findings(documents(spark, rows)).collect()}
    assert got == {1: 400_000}


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    own = [(10 ** 9 + k, f"{prose(k, 30)}\n{t}\n{prose(k + 90, 30)}") for k, (t, _) in enumerate(CASES[:-2])]
    plain = [(2 * 10 ** 9 + k, f"{prose(k, 30)} the {c}: {w} and {prose(k, 9)}")
             for k, (c, w) in enumerate([("key", "understanding"), ("password", "required"), ("token", "economy")])]
    got = secrets.scan(docs.unionByName(spark.createDataFrame(own + plain, docs.schema)))
    return got.where(F.col("doc_id") >= 10 ** 9).collect()


def test_secret_scan_keeps_planted_assignments(scanned):
    secret = {(r["doc_id"], r["token"]) for r in scanned if r["is_secret"]}
    planted = {(10 ** 9 + k, want) for k, (_, want) in enumerate(CASES[:-2])}
    assert planted <= secret, [(r["token"], r["probability"]) for r in scanned]
    assert not {t for i, t in secret if i >= 2 * 10 ** 9}
