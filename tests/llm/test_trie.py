"""Conversation trie: against a trie made by hand, against its SQL, hard cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerfleet.llm import queries, trie
from tests.oracle_harness import compare, duck

ROWS = "conv_id long, turn long, role string, text string, depth long, path string"


def by_hand(convs):
    """Nodes of {conv_id: [(role, text), ...]}, from a dictionary of prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, who in members.items():
        below = [p for p in members if p[:len(path)] == path]
        kids = {p for p in below if len(p) == len(path) + 1}
        leaves = [p for p in below if not any(len(o) == len(p) + 1 and o[:len(p)] == p for o in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(path))
        out.add((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(kids), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, role.encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())
    convs = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return convs


def nodes(df):
    rows = [tuple(r) for r in df.select(*trie.NODE_COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def built(spark, rows, most=trie.MAX_STRINGS, parts=4):
    return nodes(trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, ROWS).repartition(parts)), most))


def forest(seed, n, deep=7, wide=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(1, deep)):
            rows.append((c * 3, t, rnd.choice(["user", "assistant"]), "w" * rnd.randrange(wide), 0, ""))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1, 3, 20, 4096])
def test_equals_a_trie_by_hand_at_any_burst_size(spark, most):
    rows = forest(1, 150)
    assert built(spark, rows, most) == by_hand(ordered(rows))


@pytest.mark.parametrize("most", [1, 4096])
def test_copies_a_long_shared_opening_and_growing_prefixes(spark, monkeypatch, most):
    monkeypatch.setattr(trie, "BLOCK_IDS", 7)
    rows = [(c, t, "user", f"copy {t}", 0, "") for c in range(60) for t in range(3)]              # exact copies
    rows += [(100 + c, t, "user", f"long {t}", 0, "") for c in range(6) for t in range(40)]       # shared by 40 turns
    rows += [(100 + c, 40, "assistant", f"end {c}", 0, "") for c in range(6)]
    rows += [(200 + c, t, "user", f"grow {t}", 0, "") for c in range(12) for t in range(c + 1)]   # each a prefix of the next
    assert built(spark, rows, most) == by_hand(ordered(rows))


@pytest.mark.parametrize("most", [1, 4096])
def test_hard_rows(spark, most):
    rows = [(1, None, None, None, 0, ""), (1, 0, "user", "", 0, ""), (1, 0, "user", "", 0, ""), (2, None, "", "", 0, ""),
            (3, 5, "user", "a", 0, ""), (3, 5, "user", "b", 0, ""), (3, 5, "assistant", "c", 0, ""), (None, 0, "user", "x", 0, ""),
            (4, 0, "use", "rx", 0, ""), (5, 0, "user", "x", 0, ""), (6, 0, "user", "é😀" * 30_000, 0, ""),
            (-7, 0, "user", "é😀" * 30_000, 0, ""), (-7, 1, "user", "more", 0, "")]
    assert built(spark, rows, most) == by_hand(ordered(rows))


def test_openings_and_conversations_without_turns(spark):
    rows = forest(5, 250) + [(c, t, "user", f"t{t}", 0, "") for c in (901, 902, 903, 904, 905, 906) for t in range(2)]
    seqs = trie.sequences(spark.createDataFrame(rows, ROWS))
    conv = F.col("conv_id")
    opened = trie.with_openings(seqs, conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5)
    own, want = ordered(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    assert any(not w for w in want.values())
    assert nodes(trie.prefix_trie(opened, 4)) == by_hand(want)


def test_only_turnless_conversations_and_the_empty_table(spark):
    one = spark.sql("SELECT 9L AS conv_id, CAST(array() AS array<struct<id:binary,size:bigint>>) AS turns")
    assert nodes(trie.prefix_trie(one)) == by_hand({9: []})
    assert built(spark, []) == set()


@pytest.mark.parametrize("hard", [False, True])
def test_matches_its_sql(spark, scratch, hard):
    d = "/root/testdata/sf0.001"
    con = duck(d)
    if hard:
        d = scratch
        rows = [r[:4] for r in forest(9, 200)] + [(7, None, None, None), (7, None, None, "x"), (None, 1, "user", "x"), (8, 1, "user", "x"),
                                                  (8, 1, "user", "y")]
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
        con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    r = compare(spark, con, d, "op12_conversation_trie", queries.op12_conversation_trie, queries.ORACLE["op12_conversation_trie"])
    assert r["ok"], r
