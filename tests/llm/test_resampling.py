"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib

from tests.llm.conftest import ODD
from tributary.llm import resampling

WORD = re.compile(resampling.WORDS)
TARGETS = [("river stone river",), ("Stone bridge",), (None,), ("",)]


def plain(rows, targets, buckets, min_words, percent, seed):
    def buckets_of(text):
        low = (text or "").translate(str.maketrans(resampling.UPPER, resampling.LOWER))
        return [zlib.crc32(w.encode()) % buckets for w in WORD.findall(low)]

    own = [(d, buckets_of(t)) for d, t in rows]
    goal = [b for (t,) in targets for b in buckets_of(t)]
    every = [b for _, bs in own for b in bs]
    S, T = len(every), len(goal)
    gain = {
        b: math.floor(1000 * math.log((goal.count(b) + 1) * (S + buckets) / ((every.count(b) + 1) * (T + buckets))))
        for b in set(every)
    }
    out = []
    for d, bs in own:
        weight = math.floor(sum(gain[b] for b in bs) / len(bs)) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    drawn = able[: percent * len(able) // 100]
    ranks = {}
    for rank, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(rank)
    return sorted(((*r, ranks[r].pop(0) if ranks.get(r) else None) for r in out), key=str)


def found(spark, frame, rows, targets=TARGETS, **options):
    goal = spark.createDataFrame(targets, "text string")
    return sorted(map(tuple, resampling.resample(frame(rows), goal, **options).collect()), key=str)


def documents():
    words = "river stone bridge cloud and the of".split()
    return [(i, " ".join(words[(i * j) % 7] for j in range(1 + i % 40)), "en", "s") for i in range(120)]


def test_equals_the_plain_version(spark, frame):
    rows = documents() + ODD
    expected = plain([r[:2] for r in rows], TARGETS, 50, 5, 30, "x")
    assert found(spark, frame, rows, buckets=50, min_words=5, percent=30, seed="x") == expected
    assert sum(r[4] is not None for r in expected) > 20


def test_ties_and_repeats_are_split_exactly(spark, frame):
    """A third of all rows is one row, two lengths tie on the same id."""
    rows = documents()[:20] + [(7, "river stone " * 10, "en", "s")] * 40 + [(7, "river " * 10 + "stone " * 10, "en", "s")] * 3
    rows += [(None, "river stone " * 10, "en", "s")] * 10
    for percent in (10, 50, 90, 100):
        expected = plain([r[:2] for r in rows], TARGETS, 50, 2, percent, "x")
        assert found(spark, frame, rows, buckets=50, min_words=2, percent=percent, seed="x") == expected


def test_empty_tables(spark, frame):
    assert found(spark, frame, []) == []
    none = found(spark, frame, documents(), targets=[], percent=0)
    assert len(none) == 120 and all(r[4] is None for r in none)


def test_bisection_meets_every_count(spark):
    rows = spark.createDataFrame([(v,) for v in (-5, -5, -5, 0, 3, 3, 1 << 40)], "v long")
    got = [resampling.smallest_reaching(rows, "v", n) for n in range(1, 8)]
    assert got == [(-5, 0)] * 3 + [(0, 3)] + [(3, 4)] * 2 + [(1 << 40, 6)]


def test_longer_runs(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",)], "text string")
    runs = [r[0] for r in df.select(resampling.features(resampling.words(df.text), (1, 2))).collect()]
    assert runs == [["a", "b", "c", "a b", "b c"], ["a"], []]
