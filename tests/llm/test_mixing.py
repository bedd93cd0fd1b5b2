import math
from collections import Counter, defaultdict
from hashlib import md5

import pytest
import regex

from tests.llm.conftest import ODD
from tributary.llm import mixing
from tributary.llm.common import WORD_RE


def brute(rows):
    """Targets by resharing in rounds, then the documents in key order."""
    docs = []
    for doc_id, text, _, source in ((*r, None, None)[:4] for r in rows):
        size = len(WORD_RE.findall(text or ""))
        u = (int(md5(f"{mixing.SEED}|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        w = 0.05 + 0.95 * len(regex.findall(r"\p{L}", text)) / len(text) if text else 1.0
        docs.append((doc_id, source, size, -math.log(u) / w))
    sizes = Counter()
    for _, source, size, _ in docs:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, s in enumerate(order)}
    stop = {s: mixing.MAX_EPOCHS * sizes[s] for s in order}
    target, open_sources, left = {}, set(order), mixing.SHARE * sum(sizes.values())
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if level * weight[s] >= stop[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_sources}
            break
        target |= {s: float(stop[s]) for s in over}
        left -= sum(stop[s] for s in over)
        open_sources -= over
    taken = {}
    for s in order:
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, upto = target[s] - epochs * sizes[s], 0
        for doc_id, source, size, key in sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], d[0] is not None, str(d[0]), d[2])):
            upto += size
            more = rest > 0 and upto - size / 2 <= rest
            taken[doc_id, source, size] = size * (epochs + more)
    return sizes, target, taken, docs


def check(df, rows, buckets):
    sizes, target, taken, docs = brute(rows)
    got = mixing.mix(df, buckets=buckets).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == taken[r.doc_id, r.source, r.size]
        assert r.taken <= 2 * r.size
    words = defaultdict(int)
    for r in got:
        words[r.source] += r.taken
    largest = max(d[2] for d in docs)
    for s in sizes:
        assert abs(words[s] - target[s]) <= largest


def corpus(n):
    return [(i, "word " * (1 + i * 7 % 23) + "9 " * (i % 5), "en", f"s{min(i % 11, 4)}" if i % 13 else None) for i in range(n)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_like_the_brute_force_version(frame, buckets):
    rows = corpus(400)
    check(frame(rows), rows, buckets)


def test_many_sources_are_joined_without_a_broadcast(frame, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    rows = corpus(200)
    check(frame(rows), rows, 16)


def test_texts_are_not_shuffled(frame):
    plan = mixing.mixed_documents(frame(corpus(50), partitions=1))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(source" not in plan.split("Generate")[1].split("BroadcastExchange")[0]


def test_odd_rows(frame):
    rows = [r for i, r in enumerate(ODD) if i != 4]
    check(frame(rows), rows, 16)
    assert mixing.mix(frame(ODD)).count() == len(ODD)


def test_reruns_agree(frame):
    rows = corpus(200)
    one = sorted(map(tuple, mixing.mix(frame(rows, partitions=2)).select("doc_id", "taken").collect()))
    assert one == sorted(map(tuple, mixing.mix(frame(rows, partitions=7)).select("doc_id", "taken").collect()))


def test_mixed_documents_repeat_rows(frame):
    rows = corpus(150)
    df = frame(rows)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    want = {r.doc_id: r.epochs for r in mixing.mix(df).collect() if r.epochs and r.size}
    assert copies == want


def test_empty_tables(frame):
    assert mixing.mix(frame([])).collect() == []
    assert mixing.mix(frame([(1, None), (2, "")])).count() == 2
    assert mixing.mixed_documents(frame([])).collect() == []
