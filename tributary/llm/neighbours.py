"""Approximate nearest neighbours by inner product with an adaptive dimension scan.

Index: every vector x gets one more component sqrt(M^2 - |x|^2), M being the
largest norm, so that the largest inner product is the smallest distance. A
bounded sample fits k-means centroids, a seeded random rotation, and the number
of lists to probe for ``TARGET_RECALL`` on the sample's own neighbours. Every
vector is then assigned to the list of its nearest centroid.

Search: a query visits its probed lists. Distances are added up over blocks of
rotated components; after each block a candidate is abandoned if its partial
distance, scaled to all components and lowered by the test's margin, is beyond
the query's bound (``EPSILON`` standard deviations of the share of a distance
that lies in some components of a random rotation). The bound is the distance of the query's last wanted
neighbour within the sample, which the sought one can't exceed. Survivors are
scored exactly: the inner product of the original vectors in double precision.

Copies of one vector are searched once: distinct vectors carry their ``2 +
TOP_K`` smallest ids, enough for any result without the query's own row. Lists
are packed into shards of at most ``ROWS_PER_SHARD`` rows (long lists are split
by hash). A vector travels once, to its shard; the queries' visits are sorted
behind it and scanned in blocks of ``QUERIES_PER_BLOCK``, so a task holds one
shard and one block.

Edge cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without vec_id or of another length than the most
common one; of rows that repeat a vec_id the one with the smallest vector
counts; components that are not floats count as doubles; ties go to the smaller vec_id; fewer candidates than ``TOP_K`` give
them all; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import hash52, ship_package, shuffle_partitions, stage_table

TOP_K = 20
QUERY_EVERY = 20
SAMPLE_ROWS = 8192
CALIBRATION_QUERIES = 128
TARGET_RECALL = 0.97
MAX_LISTS = 1024
ROWS_PER_SHARD = 8192
QUERIES_PER_BLOCK = 4096
BLOCK_DIMS = 16
EPSILON = 2.1
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: components as stored
    if they are floats, otherwise as doubles."""
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", finite)
        & F.exists("embedding", lambda x: x != 0)
    )
    return kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


@dataclass
class Index:
    """What the bounded sample fits; a few MB, the same on every worker."""

    ids: np.ndarray  # sampled vec_ids
    sample: np.ndarray  # their vectors
    centroids: np.ndarray  # of augmented vectors
    rotation: np.ndarray
    norm: float  # M
    probes: int

    def augment(self, x: np.ndarray) -> np.ndarray:
        """Candidates' form: one more component that makes all norms M."""
        x = x.astype(np.float64)
        rest = np.maximum(0.0, self.norm**2 - (x * x).sum(axis=1))
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def lists(self, x: np.ndarray) -> np.ndarray:
        """List of each candidate."""
        return nearest(self.augment(x), self.centroids)[:, 0]

    def probe(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probed lists and squared-distance bound of each query."""
        q = q.astype(np.float64)
        padded = np.hstack([q, np.zeros((len(q), 1))])
        order = nearest(padded, self.centroids, self.probes)
        wanted = TOP_K + 2  # the query itself may be in the sample
        if len(self.sample) < wanted:
            return order, np.full(len(q), np.inf)
        score = -np.partition(-(q @ self.sample.T.astype(np.float64)), wanted - 1, axis=1)[:, wanted - 1]
        return order, (q * q).sum(axis=1) + self.norm**2 - 2 * score

    def known(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vec_id, score) of the best sampled vectors."""
        score = q.astype(np.float64) @ self.sample.T.astype(np.float64)
        k = min(TOP_K + 1, score.shape[1])
        best = np.argpartition(-score, k - 1, axis=1)[:, :k].ravel()
        rows = np.repeat(np.arange(len(q)), k)
        return rows, self.ids[best], scores_of(q, self.sample, rows, best)


def nearest(x: np.ndarray, centroids: np.ndarray, k: int = 1) -> np.ndarray:
    """Indexes of the k nearest centroids of each row, nearest first."""
    d = (centroids * centroids).sum(axis=1)[None, :] - 2 * (x @ centroids.T)
    if k == 1:
        return d.argmin(axis=1)[:, None]
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def fit_index(ids: np.ndarray, sample: np.ndarray, n_vectors: int, norm: float) -> Index:
    """k-means, rotation and number of probes from the sample."""
    random = np.random.default_rng(SEED)
    dims = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(random.standard_normal((dims, dims)))
    index = Index(ids, sample, np.zeros((1, dims)), rotation, norm, 1)
    points = index.augment(sample)
    n_lists = max(1, min(MAX_LISTS, len(sample) // 32, round(math.sqrt(n_vectors))))
    centroids = points[random.choice(len(points), n_lists, replace=False)]
    for _ in range(8):
        at = nearest(points, centroids)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, points)
        counts = np.bincount(at, minlength=n_lists)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
    index.centroids = centroids
    at = nearest(points, centroids)[:, 0]
    chosen = random.choice(len(points), min(CALIBRATION_QUERIES, len(points)), replace=False)
    q = sample[chosen].astype(np.float64)
    scores = q @ sample.T.astype(np.float64)
    scores[np.arange(len(q)), chosen] = -np.inf
    top = np.argsort(-scores, axis=1, kind="stable")[:, : min(TOP_K, max(1, len(points) - 1))]
    order = nearest(np.hstack([q, np.zeros((len(q), 1))]), centroids, n_lists)
    position = np.argsort(order, axis=1)  # place of each list in the query's order
    needed = np.take_along_axis(position, at[top], axis=1) + 1
    index.probes = int(min(n_lists, max(1, np.quantile(needed, TARGET_RECALL, method="higher"))))
    return index


def scores_of(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Inner products of row pairs in double precision."""
    out = np.empty(len(qi))
    for at in range(0, len(qi), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", q[qi[part]].astype(np.float64), x[xi[part]].astype(np.float64))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array<float> or array<double> column without nulls as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scan_lists(
    index: Index, q: np.ndarray, bound: np.ndarray, probed: list[np.ndarray], x: np.ndarray, lists: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Surviving (query row, candidate row) pairs of the adaptive dimension scan."""
    dims = index.rotation.shape[0]
    q_rot = np.hstack([q.astype(np.float64), np.zeros((len(q), 1))]) @ index.rotation
    x_rot = index.augment(x) @ index.rotation
    found_q, found_x = [], []
    by_list: dict[int, list[int]] = {}
    for row, own in enumerate(probed):
        for number in own:
            by_list.setdefault(int(number), []).append(row)
    order = np.argsort(lists, kind="stable")
    edges = np.searchsorted(lists[order], [*range(int(lists.max(initial=-1)) + 2)])
    for number, rows in sorted(by_list.items()):
        if number + 1 >= len(edges) or edges[number] == edges[number + 1]:
            continue
        members, asking = order[edges[number] : edges[number + 1]], np.array(rows)
        # Blocks for all pairs of the list while many are alive, then for survivors.
        q_own, x_own, limits = q_rot[asking], x_rot[members], bound[asking]
        partial, done = np.zeros((len(asking), len(members))), 0
        while True:
            stop = min(done + BLOCK_DIMS, dims)
            a, b = q_own[:, done:stop], x_own[:, done:stop]
            partial += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
            done = stop
            alive = partial <= limit(limits, done, dims)[:, None]
            if done == dims or 4 * np.count_nonzero(alive) < alive.size:
                break
        qi, xi = np.nonzero(alive)
        partial = partial[qi, xi]
        qi, xi = asking[qi], members[xi]
        while done < dims and len(qi):
            stop = min(done + BLOCK_DIMS, dims)
            step = q_rot[qi, done:stop] - x_rot[xi, done:stop]
            partial = partial + (step * step).sum(axis=1)
            done = stop
            alive = partial <= limit(bound[qi], done, dims)
            qi, xi, partial = qi[alive], xi[alive], partial[alive]
        found_q.append(qi)
        found_x.append(xi)
    if not found_q:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_q), np.concatenate(found_x)


def limit(bound: np.ndarray, done: int, dims: int) -> np.ndarray:
    """Largest partial distance after ``done`` components that is not abandoned.

    Under a random rotation the share of a distance that lies in ``done`` of
    ``dims`` components follows a beta law; a distance equal to the bound stays
    unless its share is ``EPSILON`` standard deviations above the mean.
    """
    if done >= dims:
        return bound * (1 + 1e-9) + 1e-9
    deviation = math.sqrt(2 * (dims - done) / (done * (dims + 2)))
    return bound * (done / dims) * (1 + EPSILON * deviation)


def _pack(counts: dict[int, int]) -> dict[int, list[int]]:
    """Shards of each list: short lists share one, long lists are split."""
    shards: dict[int, list[int]] = {}
    shard, rows = 0, 0
    for number in sorted(counts):
        n = counts[number]
        if n > ROWS_PER_SHARD:
            if rows:
                shard, rows = shard + 1, 0
            pieces = math.ceil(n / ROWS_PER_SHARD)
            shards[number] = list(range(shard, shard + pieces))
            shard += pieces
            continue
        if rows + n > ROWS_PER_SHARD:
            shard, rows = shard + 1, 0
        shards[number] = [shard]
        rows += n
    return shards


def _is_query(vec_id: Column) -> Column:
    return vec_id % QUERY_EVERY == 0


def search(vectors: DataFrame) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``TOP_K`` nearest rows found
    for each row whose vec_id is divisible by ``QUERY_EVERY``."""
    spark = ship_package(vectors.sparkSession)
    rows = usable(vectors).withColumn("_dims", F.size("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    stats = rows.groupBy("_dims").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).orderBy(F.col("n").desc(), "_dims").limit(1).collect()
    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_vectors, largest = stats[0].n, stats[0].m
    rows = rows.where(F.col("_dims") == stats[0]._dims).drop("_dims")
    kind = dict(rows.dtypes)["embedding"]
    sample = rows.orderBy(hash52(F.lit("sample"), F.col("vec_id").cast("string")), "vec_id").limit(SAMPLE_ROWS)
    sampled = sample.select("vec_id", "embedding").toArrow()  # SAMPLE_ROWS rows at most
    index = fit_index(sampled["vec_id"].to_numpy(), matrix(sampled["embedding"]), n_vectors, largest)
    shared = spark.sparkContext.broadcast(index)  # bounded by SAMPLE_ROWS and MAX_LISTS

    # Distinct vectors with their smallest ids, and the list of each.
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = (
        rows.withColumn("_n", F.row_number().over(copies))
        .where(F.col("_n") <= TOP_K + 2)
        .groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "ids", "embedding")
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = shared.value.lists(matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lists, pa.int32())], names=["rep", "ids", "embedding", "list"]
                )

    indexed = stage_table(
        distinct.mapInArrow(assign, f"rep long, ids array<long>, embedding {kind}, list int"), "vector-lists"
    )
    shards = _pack({r.list: r["count"] for r in indexed.groupBy("list").count().collect()})  # MAX_LISTS rows at most

    # Query rows and the distinct vector of each; equal vectors are searched once.
    asked = stage_table(
        rows.where(_is_query(F.col("vec_id")))
        .withColumnRenamed("vec_id", "query_id")
        .join(indexed.select("rep", "embedding"), "embedding")
        .select("query_id", "rep"),
        "vector-queries",
    )
    queries = indexed.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "embedding")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            if batch.num_rows:
                order, bound = shared.value.probe(matrix(batch.column(1)))
                for row in range(batch.num_rows):
                    visits: dict[int, list[int]] = {}
                    for number in order[row].tolist():
                        for shard in shards.get(number, ()):
                            visits.setdefault(shard, []).append(number)
                    out.extend((row, shard, bound[row], lists) for shard, lists in visits.items())
            at, shard, bounds, lists = zip(*out, strict=True) if out else ((), (), (), ())
            own = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), own.column(0), pa.array(bounds, pa.float64()), pa.array(lists, pa.list_(pa.int32())), own.column(1)],
                names=["shard", "rep", "bound", "lists", "embedding"],
            )

    visits = queries.mapInArrow(probe, f"shard int, rep long, bound double, lists array<int>, embedding {kind}")
    first = F.create_map(*[x for number, own in shards.items() for x in (F.lit(number), F.lit(own[0]))])
    pieces = F.create_map(*[x for number, own in shards.items() for x in (F.lit(number), F.lit(len(own)))])
    shard = first[F.col("list")] + F.pmod(F.xxhash64("rep"), pieces[F.col("list")]).cast("int")
    stored = indexed.select(shard.cast("int").alias("shard"), "list", "ids", "embedding")
    at_a_time = QUERIES_PER_BLOCK

    def scan(stored: pa.Table, visits: pa.Table) -> pa.Table:
        empty = pa.table({"rep": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not stored.num_rows or not visits.num_rows:
            return empty
        index = shared.value
        x, q = matrix(stored["embedding"]), matrix(visits["embedding"])
        qi, xi = scan_lists(
            index, q, visits["bound"].to_numpy(), visits["lists"].to_pylist(), x, stored["list"].to_numpy()
        )
        scores = scores_of(q, x, qi, xi)
        # Best distinct vectors per query, then their ids.
        order = np.lexsort((-scores, qi))
        qi, xi, scores = qi[order], xi[order], scores[order]
        rep, ids = visits["rep"].to_numpy(), stored["ids"].to_pylist()
        out_q, out_x, out_s = [], [], []
        edges = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1], True]) if len(qi) else np.zeros(1, dtype=int)
        for start, stop in zip(edges, edges[1:], strict=False):
            last, pairs = stop - 1, []
            if stop - start > TOP_K + 2:  # all that tie with the last wanted one stay
                last = start + np.searchsorted(-scores[start:stop], -scores[start + TOP_K + 1], side="right") - 1
            for k in range(start, last + 1):
                pairs.extend((-scores[k], v) for v in ids[xi[k]])
            pairs.sort()
            for s, v in pairs[: TOP_K + 1]:
                out_q.append(rep[qi[start]])
                out_x.append(v)
                out_s.append(-s)
        return pa.table({"rep": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_x, pa.int64()), "score": pa.array(out_s, pa.float64())})

    def scan_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's vectors come first and are held; its visits pass in blocks."""
        now, held, asking = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if held and asking:
                yield from scan(pa.Table.from_batches(held), pa.Table.from_batches(asking)).to_batches()
            asking.clear()

        for batch in batches:
            own, visit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (visit[1:] != visit[:-1]), True]) if len(own) else [0]
            for start, stop in zip(edges, edges[1:], strict=False):
                if own[start] != now:
                    yield from flush()
                    now, held = own[start], []
                if not visit[start]:
                    held.append(batch.slice(start, stop - start))
                    continue
                for at in range(start, stop, at_a_time):
                    part = batch.slice(at, min(at_a_time, stop - at))
                    if sum(map(len, asking)) + len(part) > at_a_time:
                        yield from flush()
                    asking.append(part)
        yield from flush()

    # A vector travels once, to its shard; a query's visits go to the shards that it probes.
    both = stored.withColumn("visit", F.lit(0)).unionByName(visits.withColumn("visit", F.lit(1)), allowMissingColumns=True)
    found = (
        both.select("shard", "visit", "list", "ids", "rep", "bound", "lists", "embedding")
        .repartition(shuffle_partitions(spark), "shard")
        .sortWithinPartitions("shard", "visit")
        .mapInArrow(scan_shards, "rep long, vec_id long, score double")
    )

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, ids, score = shared.value.known(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(ids, pa.int64()), pa.array(score)], names=["rep", "vec_id", "score"]
                )

    sampled_best = queries.select("rep", "embedding").mapInArrow(known, "rep long, vec_id long, score double")
    # A row may come from the sample and from its list, so twice the number is kept.
    best = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    merged = (
        found.unionByName(sampled_best)
        .withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") <= 2 * (TOP_K + 1))
        .groupBy("rep")
        .agg(F.array_sort(F.array_distinct(F.collect_list(F.struct((-F.col("score")).alias("less"), F.col("vec_id"))))).alias("near"))
    )
    own = F.filter("near", lambda n: n["vec_id"] != F.col("query_id"))
    return (
        asked.join(merged, "rep")
        .select("query_id", F.posexplode(F.slice(own, 1, TOP_K)).alias("_at", "_near"))
        .select(
            "query_id", (F.col("_at") + 1).cast("int").alias("rank"),
            F.col("_near.vec_id").alias("vec_id"), (-F.col("_near.less")).alias("score"),
        )
    )
