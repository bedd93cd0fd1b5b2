import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tributary.llm import suffixes


def brute(rows):
    """One result per row; rows that repeat doc_id and text are one document."""
    texts = sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, found = set(), {}
    for i, text in texts:
        data = text.encode()
        marked = np.zeros(len(data) + 1, dtype=np.int64)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                marked[p] += 1
                marked[p + 100] -= 1
            seen.add(window)
        cover = np.cumsum(marked[:-1]) > 0
        spans = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(cover) else 0
        kept = bytes(b for b, c in zip(data, cover, strict=True) if not c)
        found[i, text] = (i, len(data), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((found[i, t or ""] for i, t, *_ in rows), key=str)


def got(df):
    return sorted(map(tuple, suffixes.find_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def corpus(seed=1, n=60):
    r = random.Random(seed)
    some = lambda k: "".join(r.choices("abcdeé \n", k=k))
    passages = [some(r.randrange(60, 400)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [some(r.randrange(0, 200))]
        for _ in range(r.randrange(0, 4)):
            p = r.choice(passages)
            a, b = sorted(r.sample(range(len(p)), 2))
            parts += [p[a:b] if r.random() < 0.5 else p, some(r.randrange(0, 30))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(frame, seed):
    rows = corpus(seed)
    assert got(frame(rows)) == brute(rows)


def test_repetitive_texts(frame):
    rows = [
        (1, "a" * 500), (2, "ab" * 300), (3, "abc" * 40), (4, "xyz" + "a" * 120), (5, "b" + "ab" * 60),
        (6, "line of text, again\n" * 30), (7, "\x00" * 150), (8, "q" * 99), (9, "q" * 100), (10, "q" * 100),
    ]
    assert got(frame(rows)) == brute(rows)


def test_copies_and_many_shared_passages(frame, monkeypatch):
    monkeypatch.setattr(suffixes, "LOCAL_RUNS", 64)
    monkeypatch.setattr(suffixes, "SORT_BYTES", 2000)
    base = corpus(5, 1)[0][1] + "common passage " * 3 + "".join(random.Random(9).choices("klmnop ", k=300))
    rows = [(i, base if i % 3 else f"{i} {base[: 100 + i * 7]} {i * 31}") for i in range(40)] + corpus(6, 20)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert got(frame(rows, partitions=5)) == brute(rows)


@pytest.mark.parametrize("hot", [1, 2, 5])
def test_hot_names_are_split(frame, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_RUNS", hot)
    r = random.Random(13)
    base = "".join(r.choices("abcdefgh ", k=900))
    rows = []
    for i in range(30):
        own = list(base)
        for _ in range(r.randrange(0, 9)):
            own[r.randrange(len(own))] = r.choice("XYZ")
        rows.append((i, "".join(own)))
    rows += [(100, "a" * 400), (101, "ba" * 200), (102, "a" * 150)]
    assert got(frame(rows, partitions=4)) == brute(rows)


def test_odd_rows(frame):
    rows = [r for r in ODD if r[0] != 5] + [(5, "ab " * 2_000), (None, "z" * 150), (7, "z" * 150), (7, "z" * 150), (1, "")]
    assert got(frame(rows)) == brute(rows)
    assert got(frame([])) == []


def test_pieces_of_long_texts(monkeypatch):
    text = corpus(8, 1)[0][1].encode() * 8
    whole = suffixes.runs(text)
    monkeypatch.setattr(suffixes, "PIECE", 150)
    parts = suffixes.runs(text)
    assert np.repeat(whole[0], whole[2]).tolist() == np.repeat(parts[0], parts[2]).tolist()


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_difference_cover_order(letters):
    r = random.Random(letters)
    for _ in range(150):
        s = [r.randrange(1, letters + 1) for _ in range(r.randrange(0, 70))]
        order = suffixes.suffix_order(np.array(s, dtype=np.int64), length=10**9).tolist()
        assert order == sorted(range(len(s)), key=lambda i: s[i:])


def test_bounded_order_keeps_equal_prefixes_together():
    base = np.random.default_rng(1).integers(1, 4, 300)
    s = np.concatenate([np.tile(base, 6), [4], base[50:], np.ones(400, dtype=np.int64)])
    order = suffixes.suffix_order(s, length=100)
    assert sorted(order.tolist()) == list(range(len(s)))
    keys = [tuple(s[i : i + 100].tolist()) for i in order]
    assert keys == sorted(keys)


def test_without_repeats(frame):
    rows = corpus(3) + [(1000, None), (1001, "")]
    docs = frame(rows)
    cut = suffixes.without_repeats(docs)
    assert cut.schema == docs.schema
    texts = {r.doc_id: r for r in cut.collect()}
    for doc_id, n, removed, _, sha in brute(rows):
        text = texts[doc_id].text
        assert texts[doc_id].n_chars == (None if text is None else len(text))
        if removed == 0:
            assert hashlib.sha256((text or "").encode()).hexdigest() == sha
        else:
            assert n - removed - 6 <= len(text.encode()) <= n - removed
