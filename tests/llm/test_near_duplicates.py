import random

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tributary.llm import near_duplicates as near
from tributary.llm.common import WORD_RE
from tributary.llm.graph import connected_components


def shingle_set(text):
    words = WORD_RE.findall(text or "")
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows):
    """(doc_id, class, links) of every row, by all pairs."""
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        known = [x for x in groups[find(i)] if x is not None]
        out.append((r[0], min(known) if known else None, links[i]))
    return sorted(out, key=str)


def corpus(seed=1, families=12):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    rows, at = [], 100
    for _ in range(families):
        base = [word() for _ in range(r.randrange(30, 200))]
        for _ in range(r.randrange(1, 9)):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                own[r.randrange(len(own))] = word()
            rows.append((at, r.choice([" ", "\n", "  "]).join(own)))
            at += 1
    r.shuffle(rows)
    return rows


def got(df):
    return sorted(((x.doc_id, x.class_id, x.n_links) for x in near.join_documents(df).collect()), key=str)


def test_like_all_pairs(frame):
    rows = corpus()
    assert got(frame(rows)) == brute(rows)


def test_odd_rows(frame):
    rows = ODD + [(None, "one two three"), (8, "one  two\nthree"), (9, "One two three")]
    assert got(frame(rows)) == brute(rows)
    assert got(frame([])) == []
    assert got(frame([(1, None), (2, None)])) == [(1, 1, 0), (2, 2, 0)]


def test_large_groups_are_verified_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_DOCS", 8)
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        own[r.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows += corpus(7, 4)
    assert got(frame(rows)) == brute(rows)


def test_many_texts_of_one_doc_id(frame):
    r = random.Random(6)
    base = [f"w{i}" for i in range(80)]
    rows = [(None if i % 2 else 5, " ".join([*base[: r.randrange(80)], f"x{i}", *base[-40:]])) for i in range(120)]
    rows += [rows[0]] * 40 + [rows[1]] * 40
    assert got(frame(rows)) == brute(rows)


def test_a_node_is_one_text_row(frame):
    rows = [(None, f"a b c d e f g h i j k l m n {i}") for i in range(50)] + [(None, "a b c d e f g h i j k l m n 0")] * 50
    docs = frame(rows)
    nodes = near.signatures(docs, 8).groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("shown"), F.count("*").alias("copies")
    )
    nodes = nodes.select("*", F.lit(1).alias("component"), F.lit(1).alias("blocks"), F.lit(0).alias("block"))
    found = near.node_texts(docs, nodes).collect()
    assert sorted(x.text for x in found) == sorted({t for _, t in rows})


def test_one_of_each(frame):
    rows = corpus(3) + [(1, None), (2, ""), (3, "same text here"), (3, "same text here"), (3, "another text of this id")]
    docs = frame(rows)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted({c for d, c, _ in brute(rows) if d != 3} - {3}) + [3, 3]
    assert sorted(x.doc_id for x in kept.collect()) == sorted(want)


def test_prefixes_are_shortened_to_the_target():
    depth = near.prefix_depth()
    assert near.expected_recall(near.THRESHOLD, depth) >= near.TARGET_RECALL
    assert near.expected_recall(near.THRESHOLD, depth + 1) < near.TARGET_RECALL
    assert near.prefix_depth(target=0.999999) < depth < near.prefix_depth(target=0.6)


def test_word_hashes_follow_the_words():
    assert len(near.word_hashes("a b  c\td\x0be")) == 5
    assert (near.word_hashes(" x yy x ")[[0]] == near.word_hashes("x")).all()
    long = "word " * 40_000
    assert len(set(near.word_hashes(long).tolist())) == 1
    assert near.word_hashes("no break")[0] != near.word_hashes("no break")[0]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (10, 11), (None, 4), (12, 11), (20, 21), (21, 20)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(50)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, 20: 20, 21: 20}
    want |= {100 + i: 100 for i in range(41)} | {500 + i: 500 for i in range(50)}
    assert found == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
