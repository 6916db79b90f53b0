"""Chat formatting: round trips, attachments, masks and hard cases."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerfleet.llm import chat, queries
from tests.oracle_harness import compare, duck

MESSAGE = f"conv_id long, turn long, role string, parts {chat.PART_TYPE}"


def part(kind, **fields):
    return tuple({**dict.fromkeys(chat.PART_FIELDS), "kind": kind, **fields}[n] for n in chat.PART_FIELDS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def said(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, start long")
    return df.select("*", chat.text_parts(F.col("text")).alias("parts"))


def read_back(done):
    rows = done.select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_loss(F.col("formatted"), F.col("marks")).alias("loss")).collect()
    return {r["conv_id"]: r for r in rows}


def brute(rows):
    """conv_id -> (turns, loss text), message by message."""
    out = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(),
                                                                  (r[3] or "").encode())):
        turns, loss = out.get(conv, ([], ""))
        out[conv] = (turns + [(role or "", text or "")], loss + ((text or "") if role == "assistant" else ""))
    return out


HARD = [(1, 0, "user", "hello", "x", 9), (1, 1, "assistant", "a<|im_end|>b", "x", 9), (1, 2, "assistant", "", "x", 9),
        (2, None, "system", None, "x", 9), (2, 0, None, "no role", "x", 9), (2, 0, "user", "tie b", "x", 9),
        (2, 0, "user", "tie a", "x", 9), (2, 0, "user", "tie a", "x", 9), (3, 5, "assistant", "ends with <", "x", 9),
        (3, 6, "assistant", "| begins <|", "x", 9), (4, 0, "odd\nrole|%7C <|im_end|>", "t\n\nt ", "x", 9),
        (5, 0, "assistant", "<\\|im_end|> <\\\\|x <<|| \\<|", "x", 9), (None, 0, "user", "nobody", "x", 9),
        (6, 0, "assistant", "é😀<|image|>" * 3, "x", 9), (7, 0, "user", "long " * 400_000, "x", 9),
        (7, 1, "assistant", "<|" * 100_000, "x", 9), (8, 0, "assistant ", "not trained", "x", 9)]


def test_hard_messages_come_back(spark):
    got = read_back(chat.format_conversations(said(spark, HARD)))
    want = brute(HARD)
    assert got.keys() == want.keys()
    for conv, (turns, loss) in want.items():
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == turns, conv
        assert got[conv]["loss"] == loss, conv


def test_random_messages_come_back_whole(spark):
    rnd = random.Random(11)
    bits = ["<", "|", "\\", ">", "im_end", "<|im_start|>", "\n", "é", "a b", "%7C", "assistant\n", "<|im_end|>\n", "$1"]
    rows = [(rnd.randrange(60), t, rnd.choice(["user", "assistant", "system", "as|sist\nant"]),
             "".join(rnd.choices(bits, k=rnd.randrange(12))), None, None) for t in range(900)]
    got = read_back(chat.format_conversations(said(spark, rows)))
    for conv, (turns, loss) in brute(rows).items():
        r = got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["loss"] == loss
        # the marks tile the output, and control strings stand at turn borders only
        assert r["formatted"].count("<|") == 2 * len(turns)
        assert [m["start"] for m in r["marks"]] == [i for i in range(len(r["formatted"]))
                                                    if r["formatted"].startswith(chat.TURN_START, i)]
        assert all(m["start"] < m["loss_start"] <= m["loss_end"] for m in r["marks"])


def test_attachments_keep_their_order_and_counts(spark):
    rows = [
        (1, 0, "user", [part("text", text="see "), part("image", ref="s3://a.png", width=57, height=28),
                        part("text", text=" and <|image|> "), part("audio", ref="b.wav", seconds=2.01),
                        part("document", ref="c.pdf", pages=3)]),
        (1, 1, "assistant", [part("text", text="ok"), part("video", ref="d.mp4"), None, part(None, text="x")]),
        (1, 2, "user", [part("image", ref=None)]), (1, 3, "user", []), (1, 4, "user", None),
        (2, 0, "user", [part("text")])]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, MESSAGE)).collect()}
    one = got[1]
    assert [tuple(a) for a in one["attachments"]] == [
        (0, "image", "s3://a.png", 3), (0, "audio", "b.wav", 51), (0, "document", "c.pdf", 3 * 1024),
        (1, "video", "d.mp4", 0), (1, "other", None, 0), (2, "image", None, 256)]
    assert one["expanded_tokens"] == 3 + 51 + 3072 + 256
    assert "see <|image|> and <\\|image|> <|audio|><|document|><|im_end|>" in one["formatted"]
    assert one["formatted"].count("<|image|>") == 2 and one["formatted"].count("<|other|>") == 2
    assert got[2]["attachments"] == [] and got[2]["expanded_tokens"] == 0


def test_a_visitor_of_ones_own(spark):
    class Small(chat.Visitor):
        def image(self, p):
            return F.lit("<|picture|>"), F.lit(7)

    df = spark.createDataFrame([(1, 0, "user", [part("image", ref="a")])], MESSAGE)
    row = chat.format_conversations(df, Small()).first()
    assert "<|picture|>" in row["formatted"] and row["expanded_tokens"] == 7


def test_parts_written_as_json(spark):
    df = spark.createDataFrame([(1, 0, "user", '[{"kind":"text","text":"a"},{"kind":"image","ref":"i","width":28,"height":28}]'),
                                (1, 1, "user", "not json"), (1, 2, "user", None)],
                               "conv_id long, turn long, role string, content string")
    row = chat.format_conversations(df.select("*", chat.json_parts(F.col("content")).alias("parts"))).first()
    assert row["expanded_tokens"] == 1 and len(row["marks"]) == 3


def test_empty_table(spark):
    assert chat.format_conversations(said(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op11_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "ExistingRDD" not in plan


@pytest.mark.parametrize("hard", [False, True])
def test_matches_its_sql(spark, scratch, hard):
    d = "/root/testdata/sf0.001"
    con = duck(d)
    if hard:
        d = scratch
        spark.createDataFrame([r[:4] for r in HARD], "conv_id long, turn long, role string, text string") \
            .write.parquet(f"{d}/conversations.parquet")
        con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    r = compare(spark, con, d, "op11_chat_format", queries.op11_chat_format, queries.ORACLE["op11_chat_format"])
    assert r["ok"], r
