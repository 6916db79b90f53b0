"""Near-duplicates among rows that share a doc_id."""

from ledgerfleet.llm import simhash
from tests.llm.edge import documents, prose


def test_rows_of_different_components_may_share_a_doc_id(spark):
    a, b, c = (prose(k, 80) for k in (1, 2, 3))
    rows = [(1, a), (2, a), (2, b), (3, b), (3, c), (3, c), (4, c)]
    kept = simhash.first_of_each_group(documents(spark, rows))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(1, a), (2, b), (3, c)])
    assert kept.columns == documents(spark, rows).columns
    both = simhash.first_of_each_group(documents(spark, [(5, a), (5, b), (5, a)]))
    assert sorted(r["text"] for r in both.collect()) == sorted([a, b])
