"""Small tables of hard cases: nulls, empty and long texts, ties, repeated
rows, clashing extra columns."""

from __future__ import annotations

import random

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, length long, start long"

LINE = "This line of a licence stands in many documents, word for word, for ever."


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    parts = ["an", "the", "ti", "on", "er", "ou", "sh", "be", "ll", "ra"]
    return " ".join("".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 60)
    long = prose(2, 40_000)
    rows = [(1, base), (2, base), (3, base + " and more of it"), (4, None), (5, ""), (6, " \t\n"), (7, "one"),
            (8, "one two"), (9, long), (10, long[:150_000] + " tail " + long[150_000:]), (11, base),
            (11, base), (None, base), (None, None), (12, "ÀÉ ß 'Tis naïve— 中文 İstanbul Σίσυφος <|endoftext|> ok"),
            (13, "x" * 700), (14, "x" * 300), (15, "ab" * 200), (16, base[:49]), (17, base[:50]), (18, base[1:51]),
            (9007199254740993, base[:120])]
    rows += [(100 + k, f"{prose(50 + k, 12)}\n{LINE}\n{prose(90 + k, 12)}") for k in range(40)]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, None if i is None else ("en", "de")[i % 2], "src0", None, 0.5, 7, -1)
                                  for i, t in rows], DOC_COLUMNS)


def empty(spark):
    return spark.createDataFrame([], DOC_COLUMNS)
