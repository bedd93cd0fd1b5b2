"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Every text is the set of its five-word shingles (64-bit hashes). Texts with the
same set are copies and form one node, which the text of one of its rows (by
doc_id and a hash of the text) stands for from there on. Each node has ``TREES`` labels, one per
prefix tree: the first ``k`` MinHash values of the tree. Prefixes start at
``MAX_DEPTH`` values and are shortened until pairs at the threshold meet in
some tree with the target recall; nodes under one trie node at that depth are
candidates. Trie nodes link their members to the smallest one, so candidates
are as many rows as memberships, never pairs. Connected candidates are verified
together on their exact shingle sets, in blocks of bounded size: a component of
more rows is dealt over pairs of blocks. A task returns one row per node, with
the number of its links and the smallest node it is linked with in the task;
the components of those rows are the classes.

Result: one row per document with its class (smallest doc_id of the class) and
its number of links: the other documents at ``THRESHOLD`` or more, copies
included.

Edge cases: texts of one to four words are one shingle of all their words;
texts without words (null, empty, blank) have no links and are a class of
their own; a null doc_id is larger than any other for the class and stays null
if all of the class are; rows that repeat a doc_id are rows of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import mix64, packed, ship_package, stage_table, tidy, unpacked
from tributary.llm.graph import connected_components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 32
MAX_DEPTH = 12
TARGET_RECALL = 0.995
#: Most documents and shingles of one block of a verified component.
BLOCK_DOCS = 1024
BLOCK_SHINGLES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = 1 << 16


def expected_recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Chance that a pair shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(target: float = TARGET_RECALL, threshold: float = THRESHOLD) -> int:
    """Longest prefix that reaches the target recall at the threshold."""
    depth = MAX_DEPTH
    while depth > 1 and expected_recall(threshold, depth) < target:
        depth -= 1
    return depth


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blank bytes, byte codes, powers of the base and of its inverse."""
    blank = np.zeros(256, dtype=bool)
    blank[[32, *range(9, 14)]] = True
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return blank, codes, _powers(_BASE, _POWERS), _powers(inverse, _POWERS)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    blank, codes, up, down = _tables()
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    n = len(data)
    if n > len(up):
        up, down = _powers(_BASE, n), _powers(down[1], n)
    inside = np.concatenate([[False], ~blank[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[:n], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts]) if len(starts) else np.zeros(0, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct five-word shingles; one shingle for shorter texts."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k = min(SHINGLE_WORDS, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = mix64(out * _BASE + words[j : j + n])
    return np.unique(out)


def node_of(found: np.ndarray) -> int | None:
    """Order-free hash of a shingle set as a signed 64-bit number."""
    if not len(found):
        return None
    total = mix64(found ^ _BASE).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(mix64(np.array([total])).view(np.int64)[0])


@cache
def _permutations(depth: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(11)
    n = TREES * depth
    a = random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, random.integers(0, 1 << 63, n, dtype=np.uint64)


def labels(found: np.ndarray, depth: int) -> np.ndarray:
    """One 64-bit label per tree: hash of its first ``depth`` MinHash values."""
    a, b = _permutations(depth)
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 1024):
        part = found[at : at + 1024, None] * a[None, :] + b[None, :]
        np.minimum(least, (part >> np.uint64(32)).min(axis=0), out=least)
    values = least.reshape(TREES, depth)
    out = np.zeros(TREES, dtype=np.uint64)
    for j in range(depth):
        out = mix64(out * _BASE + values[:, j])
    return out.view(np.int64)


def signatures(docs: DataFrame, depth: int) -> DataFrame:
    """(doc_id, node, n_shingles, labels, text_hash) per document; node is null without words."""
    kind = dict(docs.dtypes)["doc_id"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, own = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                node.append(node_of(found))
                size.append(len(found))
                own.append(labels(found, depth) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                    pa.array(own, pa.list_(pa.int64())), batch.column(2),
                ],
                names=["doc_id", "node", "n_shingles", "labels", "text_hash"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, node long, n_shingles long, labels array<long>, text_hash long"
    )


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(a, b): each node with the smallest node of its trie nodes."""
    members = nodes.select("node", F.posexplode("labels").alias("tree", "label"))
    # Two longs and an int per membership; counts and minima combine in each task.
    tries = members.groupBy("tree", "label").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    tries = tries.where(F.col("least") != F.col("most"))
    return (
        members.join(tries, ["tree", "label"])
        .where(F.col("node") != F.col("least"))
        .select(F.col("node").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Boolean matrix of the pairs (left row, right row) at the threshold."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[inverse] > 1
    owner, column = np.repeat(np.arange(len(sets)), sizes)[keep], shared[inverse[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = int((counts > 1).sum())
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, total, 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(sets), min(4096, total - at)), dtype=np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        common += part[left] @ part[right].T
    both = common.astype(np.int64)
    either = sizes[left][:, None] + sizes[right][None, :] - both
    return 5 * both >= 4 * either  # THRESHOLD in whole numbers


def verify(table: pa.Table) -> pa.Table:
    """(node, least, links) of one component or pair of its blocks."""
    node, own = table["node"].to_numpy(), table["block"].to_numpy()
    copies = table["copies"].to_numpy()
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    sets, rows = [], []
    for row, text in enumerate(table["text"]):
        found = shingles(text.as_py())
        # A text of the same doc_id and hash that differs is not this node.
        if node_of(found) == node[row]:
            sets.append(found)
            rows.append(row)
    node, own, copies = node[rows], own[rows], copies[rows]
    node, at = np.unique(node, return_index=True)
    sets, own, copies = [sets[i] for i in at], own[at], copies[at]
    links = np.zeros(len(node), dtype=np.int64)
    least = node.copy()
    if len(node) > 1:
        left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
        if len(left) and len(right):
            pairs = linked(sets, left, right)
            if first == second:
                np.fill_diagonal(pairs, False)
            links[left] += pairs @ copies[right]
            if first != second:
                links[right] += pairs.T @ copies[left]
            _spread(least, left, right, pairs)
    return pa.table({"node": pa.array(node, pa.int64()), "least": pa.array(least, pa.int64()), "links": pa.array(links, pa.int64())})


def _spread(least: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> None:
    """Smallest node reachable over the links, in place."""
    top = np.iinfo(np.int64).max
    while True:
        before = least.copy()
        least[left] = np.minimum(least[left], np.where(pairs, least[right][None, :], top).min(axis=1))
        least[right] = np.minimum(least[right], np.where(pairs, least[left][:, None], top).min(axis=0))
        if (least == before).all():
            return


def node_texts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates (nodes), each with the text that stands for it, as ``text``.

    A doc_id (or null) of many texts meets each node by its own text only;
    rows that repeat both collapse in each task before the nodes are dealt.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
        candidates, F.expr("doc_id <=> shown.doc_id and text_hash = shown.text_hash")
    )
    return texts.groupBy("component", "node", "copies", "blocks", "block").agg(F.first("text").alias("text"))


def join_documents(docs: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, n_links, node, class_node for every document; the
    class nodes tell classes apart whose smallest doc_id is the same."""
    ship_package(docs.sparkSession)
    depth = prefix_depth(target_recall)
    signed = stage_table(signatures(docs, depth), "near-signatures")
    with_words = signed.where(F.col("node").isNotNull())
    nodes = with_words.groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles"),
        F.min(F.struct("doc_id", "text_hash")).alias("shown"),
    )
    nodes = stage_table(nodes, "near-nodes")
    one_each = with_words.select("node", "labels").dropDuplicates(["node"])
    components = connected_components(candidate_edges(one_each))

    # Size of each candidate component, and the blocks it is dealt over.
    candidates = nodes.join(components, "node")
    sizes = candidates.groupBy("component").agg(
        F.ceil(
            F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    candidates = candidates.join(sizes, "component").select(
        "component", "node", "copies", "blocks", "shown",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    dealt = node_texts(docs, candidates).select(
        "component", "node", "copies", "block", "text",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "component", "node", "copies", "block", "text",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    verified = stage_table(
        dealt.groupBy("component", "i", "j").applyInArrow(verify, "node long, least long, links long"), "near-links"
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected_components(
        verified.where(F.col("node") != F.col("least")).select(F.col("node").alias("a"), F.col("least").alias("b"))
    )
    rooted = (
        nodes.join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "node", "first_doc",
            F.coalesce("component", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    named = rooted.join(least, "root").select(
        F.col("node").alias("_node"), F.col("root").alias("class_node"), "class_id", "n_links"
    )
    return signed.join(named, F.col("node") == F.col("_node"), "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "node",
        "class_node",
    )


def with_node(docs: DataFrame) -> DataFrame:
    """(row, node): the documents as structs, and their node (null without words)."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")
    rows = docs.select(packed(docs).alias("row"))
    schema = rows.select("row", F.lit(None).cast("long").alias("node")).schema

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = [node_of(shingles(t.as_py())) for t in batch.column(0).field(at)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.int64())], names=["row", "node"])

    return rows.mapInArrow(run, schema)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one of each class, with all their columns: the row
    of the smallest doc_id. Documents without words all stay."""
    found = join_documents(docs).where(F.col("node").isNotNull())
    # The rows of the class's smallest doc_id; of several nodes the smallest.
    chosen = (
        found.where(F.expr("doc_id <=> class_id"))
        .groupBy("doc_id", "class_node")
        .agg(F.min("node").alias("kept_node"))
        .select(F.col("doc_id").alias("kept_id"), "kept_node")
    )
    rows = with_node(docs).join(
        chosen, F.expr("row.doc_id <=> kept_id and node = kept_node"), "left"
    )
    copy = Window.partitionBy("row.doc_id", "node").orderBy(F.lit(0))
    return (
        rows.where(F.col("node").isNull() | F.col("kept_node").isNotNull())
        .withColumn("copy", F.row_number().over(copy))
        .where(F.col("node").isNull() | (F.col("copy") == 1))
        .select(*unpacked(docs, "row"))
    )
