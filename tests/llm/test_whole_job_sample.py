"""What the sample of suffix dedup sends to the driver."""

from pyspark.sql.classic.dataframe import DataFrame

from ledgerfleet.llm import suffix_dedup
from tests.llm.edge import LINE, documents, prose
from tests.llm.test_dedup import cut, removed


def test_suffix_sample_is_bounded_whatever_the_length(spark, monkeypatch):
    rows = [(k, f"{prose(k, 1500)} {LINE} {prose(k + 500, 40)}") for k in range(30)]
    sizes, plain = [], DataFrame.toPandas

    def counted(self):
        out = plain(self)
        sizes.append(len(out))
        return out

    monkeypatch.setattr(DataFrame, "toPandas", counted)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_LEADS", 300, raising=False)
    monkeypatch.setattr(suffix_dedup, "MOST_HOT", 50, raising=False)
    own = removed(spark, documents(spark, rows))
    assert sizes and max(sizes) < 600
    assert own == cut(rows)
