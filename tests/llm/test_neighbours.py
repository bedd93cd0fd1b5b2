import math

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "clash") for i, v in rows], SCHEMA).repartition(3)


def brute(rows):
    """Exact results by all pairs, in double precision."""
    valid = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        valid[i] = min(valid.get(i, v), v)
    out = {}
    for q in (i for i in valid if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(valid[q], valid[c], strict=True)), c) for c in valid if c != q)
        out[q] = scored[:20]
    return out


def got(df):
    found = {}
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    return found


def random_rows(n, dims=24, seed=3, scale=True):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    if scale:
        x *= r.uniform(0.2, 3.0, (n, 1))
    return [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]


def recall(found, want):
    return np.mean([len({c for _, c in found[q]} & {c for _, c in want[q]}) / len(want[q]) for q in want])


def test_recall_and_exact_scores(spark):
    rows = random_rows(3000)
    found, want = got(table(spark, rows)), brute(rows)
    assert found.keys() == want.keys()
    assert all(len(v) == 20 and v == sorted(v) for v in found.values())
    assert recall(found, want) >= 0.9
    x = dict(rows)
    for q, near in found.items():
        for s, c in near:
            assert math.isclose(-s, float(np.dot(np.array(x[q]), np.array(x[c]))), rel_tol=1e-9, abs_tol=1e-9)


def test_small_sample_and_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(neighbours, "ROWS_PER_SHARD", 64)
    monkeypatch.setattr(neighbours, "QUERIES_PER_BLOCK", 30)
    rows = random_rows(2500, seed=5)
    found, want = got(table(spark, rows)), brute(rows)
    assert all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.9


def test_few_rows_give_all_candidates_in_order(spark):
    rows = random_rows(12, dims=4)
    rows.append((20, rows[0][1]))
    found, want = got(table(spark, rows)), brute(rows)
    assert {q: [c for _, c in v] for q, v in found.items()} == {q: [c for _, c in v] for q, v in want.items()}


def test_many_copies_of_one_vector(spark):
    rows = random_rows(300, dims=8)
    rows += [(i, rows[40][1]) for i in range(1000, 1500)]
    found, want = got(table(spark, rows)), brute(rows)
    assert found.keys() == want.keys()
    for q in (q for q in want if q >= 1000):
        assert [c for _, c in found[q]] == [c for _, c in want[q]]


def test_odd_vectors_take_no_part(spark):
    rows = random_rows(60, dims=3)
    rows += [
        (100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [1.0, float("nan"), 2.0]),
        (180, [1.0, float("inf"), 2.0]), (None, [1.0, 1.0, 1.0]), (200, []), (220, [1.0, 2.0]),
        (40, rows[40][1]), (20, [9.0, 9.0, 9.0]),
    ]
    found = got(table(spark, rows))
    want = brute([r for r in rows if r[0] != 220])
    assert {q: [c for _, c in v] for q, v in found.items()} == {q: [c for _, c in v] for q, v in want.items()}


def test_empty_table(spark):
    assert neighbours.search(table(spark, [])).collect() == []
    assert neighbours.search(table(spark, [(1, None)])).collect() == []
    assert neighbours.search(table(spark, [(20, [1.0, 2.0])])).collect() == []


def test_abandoned_candidates_are_beyond_the_bound():
    rows = np.array([v for _, v in random_rows(2000, dims=63, scale=False)], dtype=np.float32)
    index = neighbours.fit_index(np.arange(2000), rows, 2000, float(np.linalg.norm(rows, axis=1).max()))
    q, bound = rows[:20], index.probe(rows[:20])[1]
    lists = index.lists(rows)
    everywhere = [np.arange(len(index.centroids)) for _ in q]
    qi, xi = neighbours.scan_lists(index, q, bound, everywhere, rows, lists)
    exact = (q.astype(float) @ rows.T.astype(float))
    kept = set(zip(qi.tolist(), xi.tolist(), strict=True))
    top = {(i, int(j)) for i in range(20) for j in np.argsort(-exact[i])[:20]}
    assert len(top & kept) >= 0.97 * len(top)
    assert len(kept) < 0.2 * exact.size


def test_double_vectors_are_scored_as_doubles(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal(6)
    # Vectors that a float tells apart from none of the others.
    rows = [(i, (base * (1 + i * 1e-12)).tolist()) for i in range(60)]
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], SCHEMA.replace("float", "double"))
    x = {i: np.array(v) for i, v in rows}
    for q, near in got(df).items():
        want = sorted((-float((x[q] * x[c]).sum()), c) for c in x if c != q)[:20]
        assert [c for _, c in near] == [c for _, c in want]
        assert all(math.isclose(s, t, rel_tol=1e-15) for (s, _), (t, _) in zip(near, want, strict=True))


def test_scan_reads_only_the_vectors(spark):
    plan = neighbours.usable(table(spark, random_rows(5)).withColumn("other", F.lit(1)))
    assert plan.columns == ["vec_id", "embedding"]
