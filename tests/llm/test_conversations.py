"""Conversation repair against a search over all edits."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tributary.llm import conversations as c

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(turns):
    """(cost, audit) of the cheapest edits by trying all with at most one
    insert before each turn and two at the end."""
    best = None
    for edits in itertools.product(*[[i + e for i in ("", "I") for e in ("D", "K", "R")] for _ in turns], ["", "I", "II"]):
        audit, cost, spelled, rows = "".join(edits), 0, [""], iter(turns)
        for e in audit:
            initial, mark = ("", "-") if e == "I" else next(rows)
            cost += {"D": 3, "I": 2, "R": 2, "K": 0}[e] + (mark == "t" and e in "KR")
            if mark == "x" and e != "D":
                cost = 1000
            if e in "IR":
                spelled = [s + r for s in spelled for r in "ua"]
            elif e == "K":
                spelled = [s + initial for s in spelled]
        if any(GRAMMAR.fullmatch(s) for s in spelled) and (best is None or (cost, audit) < best):
            best = (cost, audit)
    return best


def chained(turns, block):
    chain = c.Chain()
    for at in range(0, len(turns), block):
        chain.add(tuple(turns[at : at + block]))
    cost, pieces = chain.finish()
    return cost, "".join(audit for _, audit in pieces)


@pytest.mark.parametrize("seed", range(60))
def test_cheapest_least_audit_whatever_the_blocks(seed):
    draw = random.Random(seed)
    turns = [(draw.choice("suuaa?"), draw.choice("--tx")) for _ in range(draw.randint(1, 4))]
    expected = exhaustive(turns)
    for block in (1, 2, 4):
        assert chained(turns, block) == expected


@pytest.mark.parametrize("seed", range(10))
def test_blocks_of_long_conversations_agree(seed):
    draw = random.Random(seed)
    turns = [(draw.choice("suuaa?"), draw.choice("---tx")) for _ in range(40)]
    assert chained(turns, 3) == chained(turns, 7) == chained(turns, 16) == chained(turns, 40)


def test_bands_change_no_result():
    turns = (("u", "-"), ("u", "t"), ("a", "x"), ("a", "-"))
    for target in ("", "ua", "uaua", "suaua"):
        wide = c.align(turns, target, 10**6)
        assert (wide is None) or c.align(turns, target, wide[0]) == wide
        assert wide is None or c.align(turns, target, wide[0] - 1) is None


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("block", "phase", "audit", "digest", "marks", "copy", "_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


ODD = [
    (1, 1, "system", "Be kind."), (1, 2, "user", "Hello."), (1, 3, "assistant", "Hi."),
    (2, None, "user", "No number."), (2, 4, None, "No role."), (2, 9, "assistant", None),
    (None, 1, "user", "No conversation."), (None, 2, "assistant", "Yes."),
    (3, 1, "user", "same."), (3, 1, "user", "same."), (3, 2, "user", "same."), (3, 3, "tool", "what"),
    (4, 1, "user", "long " * 50_000 + "."), (4, 2, "assistant", "\x0b \t"),
]


def test_reports_and_turns(spark):
    report, _ = c.repair(rows_of(spark, ODD))
    found = {r.conv_id: r for r in report.collect()}
    assert (found[1].audit, found[1].cost, found[1].illegal) == ("KKK", 0, 0)
    assert (found[2].blank, found[2].gaps, found[2].illegal) == (1, 4, 2)
    assert (found[3].duplicate, found[3].truncated, found[3].gaps) == (2, 1, 0)
    assert found[3].audit == "KDDR" and found[3].cost == 9
    assert (found[4].audit, found[4].blank) == ("KDI", 1)
    turns = c.repaired_turns(rows_of(spark, ODD)).orderBy("block", "place").collect()
    assert [(r.edit, r.role, r.text) for r in turns if r.conv_id == 3] == [("K", "user", "same."), ("R", "assistant", "what")]
    assert [r.role for r in turns if r.conv_id == 1] == ["system", "user", "assistant"]


def test_digest_of_an_untouched_conversation(spark):
    _, whole = c.repair(rows_of(spark, ODD))
    sha = {r.conv_id: r.repaired_sha256 for r in c.digests(whole).collect()}
    assert sha[1] == hashlib.sha256(b"system:Be kind.\nuser:Hello.\nassistant:Hi.").hexdigest()
    assert sha[None] == hashlib.sha256(b"user:No conversation.\nassistant:Yes.").hexdigest()


def test_one_conversation_over_many_partitions(spark):
    """A conversation with most of the rows is spread over tasks and repaired as a whole."""
    long = [(5, i, "user" if i % 2 else "assistant", f"Turn {i}.") for i in range(1, 2001)]
    rows = rows_of(spark, long + ODD)
    staged = c.blocks(rows)
    assert staged.where("conv_id = 5").select(F.shiftright("block", 36)).distinct().count() > 3
    report, whole = c.repair(rows)
    assert report.where("conv_id = 5").first().audit == "K" * 2000
    expected = "\n".join(f"{role}:{text}" for _, _, role, text in long)
    sha = c.digests(whole).where("conv_id = 5").first().repaired_sha256
    assert sha == hashlib.sha256(expected.encode()).hexdigest()


def test_nothing_left_and_empty(spark):
    gone = next(i for i in range(1000) if __import__("zlib").crc32(f"{i}:1".encode()) % 20 == 0)
    row = c.repair_damaged(rows_of(spark, [(gone, 1, "user", "Hi.")])).first()
    assert (row.conv_id, row.cost, row.audit, row.repaired_sha256) == (gone, 0, "", hashlib.sha256(b"").hexdigest())
    assert c.repair_damaged(rows_of(spark, [])).collect() == []
