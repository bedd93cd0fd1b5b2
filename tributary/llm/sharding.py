"""Hierarchical weighted hash tree: documents to shards through regions and racks.

A topology is a tree of named nodes; leaves are shards with a weight, and the
weight of an inner node is the sum of its leaves. A key descends from the root:
at each level every child draws ``-ln(u) / weight`` from a hash of (key, path
of the child), and the smallest draw wins, so a child is chosen with
probability weight / sum of weights. When a child's weight grows, keys move
only into that child's subtree; draws below unchanged siblings stay as they are.

Law ``key``: the shard depends on doc_id and the shard count alone. The first
``BASE_SHARDS`` shards are 2 regions x 2 racks x 4 shards. Each further shard
joins as a region of its own (one rack, one shard), so growing by one shard
adds one child at the root and rows move only into the new shard.

All expressions are built-in functions; nothing is collected.

Edge cases: a null doc_id hashes as the empty text; a null text has size 1 and
the CRC of no bytes (0); rows that repeat a doc_id share its shard and get
slots of their own; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import hash52, key_text, shuffle_partitions, unit

BASE_SHARDS = 16
RACKS_PER_REGION = 2
SHARDS_PER_RACK = 4


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Leaves carry ``shard`` and their own weight."""

    name: str
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def topology(n_shards: int, weights: Sequence[float] | None = None) -> Node:
    """The tree for a shard count (see the module's text)."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    weights = [1.0] * n_shards if weights is None else list(weights)
    if len(weights) != n_shards or min(weights) <= 0:
        raise ValueError("one positive weight per shard is needed")

    def leaf(i: int) -> Node:
        return Node(f"s{i}", shard=i, own_weight=float(weights[i]))

    regions, per_region = [], RACKS_PER_REGION * SHARDS_PER_RACK
    base = min(n_shards, BASE_SHARDS)
    for r, first in enumerate(range(0, base, per_region)):
        racks = tuple(
            Node(f"k{k}", tuple(leaf(i) for i in range(start, min(start + SHARDS_PER_RACK, base))))
            for k, start in enumerate(range(first, min(first + per_region, base), SHARDS_PER_RACK))
        )
        regions.append(Node(f"r{r}", racks))
    for i in range(base, n_shards):
        regions.append(Node(f"r{len(regions)}", (Node("k0", (leaf(i),)),)))
    return Node("root", tuple(regions))


def descend(key: Column, root: Node) -> Column:
    """Shard of a key: the winning child at each level, ties to the first.

    The tree is a literal map from a node's path to its children, so the
    expression has one step per level whatever the number of nodes.
    """
    children, shards, depth = {}, {}, 0

    def visit(node: Node, path: str, level: int) -> None:
        nonlocal depth
        if not node.children:
            shards[path], depth = node.shard, max(depth, level)
            return
        children[path] = [(f"{path}/{c.name}", c.weight) for c in node.children]
        for c in node.children:
            visit(c, f"{path}/{c.name}", level + 1)

    visit(root, "", 0)
    table = F.create_map(
        *[
            part
            for path, below in children.items()
            for part in (
                F.lit(path),
                F.array(
                    *[
                        F.struct(F.lit(i).alias("i"), F.lit(p).alias("path"), F.lit(float(w)).alias("weight"))
                        for i, (p, w) in enumerate(below)
                    ]
                ),
            )
        ]
    )

    def drawn(child: Column) -> Column:
        d = -F.log(unit(hash52(key, child.getField("path")))) / child.getField("weight")
        return F.struct(d.alias("d"), child.getField("i").alias("i"), child.getField("path").alias("path"))

    path = F.lit("")
    for _ in range(depth):  # every shard lies at the same depth
        path = F.array_min(F.transform(F.element_at(table, path), drawn)).getField("path")
    leaves = F.create_map(*[x for p, s in shards.items() for x in (F.lit(p), F.lit(s).cast("int"))])
    return F.element_at(leaves, path)


def place(key: Column, n_shards: int, weights: Sequence[float] | None = None) -> Column:
    return descend(key, topology(n_shards, weights))


def assign_shards(
    docs: DataFrame,
    n_shards: int = BASE_SHARDS,
    weights: Sequence[float] | None = None,
    grown_weight: float = 1.0,
    slot_buckets: int | None = None,
) -> DataFrame:
    """Place every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number the rows of a shard from 0 without gaps, in the order of
    (hash of doc_id, doc_id, size, CRC). The numbering runs in two steps so
    that no task holds a shard: rows are counted per (shard, hash range), the
    small table of counts is prefix-summed, and only the rows of one hash
    range are ordered together.
    """
    buckets = slot_buckets or max(64, 4 * shuffle_partitions(docs.sparkSession))
    key = key_text(F.col("doc_id"))
    keyed = docs.select(
        F.col("doc_id"),
        F.col("text"),
        hash52(key, F.lit("slot")).alias("_h"),
        place(key, n_shards, weights).alias("shard"),
        place(key, n_shards + 1, None if weights is None else [*weights, grown_weight]).alias("grown_shard"),
    ).withColumn("_b", F.floor(F.col("_h") * F.lit(buckets) / F.lit(float(1 << 52))).cast("int"))
    # Column pruning keeps the texts out of this branch.
    counts = keyed.groupBy("shard", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = keyed.select(
        "doc_id", "_h", "_b", "shard", "grown_shard",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    inside = Window.partitionBy("shard", "_b").orderBy("_h", "doc_id", "size", "text_crc32")
    return (
        rows.withColumn("_i", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "_b"])
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_first") + F.col("_i")).cast("long").alias("slot"),
            "grown_shard",
        )
    )


def _draw_sql(path: str, weight: float) -> str:
    bits = f"('0x'||substr(md5(k||'|{path}'),1,13))::BIGINT"
    return f"(-ln((({bits})::DOUBLE + 0.5) / 4503599627370496.0) / {float(weight)!r})"


def _descend_sql(node: Node, path: str = "") -> str:
    if not node.children:
        return str(node.shard)
    paths = [f"{path}/{c.name}" for c in node.children]
    if len(node.children) == 1:
        return _descend_sql(node.children[0], paths[0])
    draws = [_draw_sql(p, c.weight) for c, p in zip(node.children, paths, strict=True)]
    least = f"least({', '.join(draws)})"
    cases = " ".join(
        f"WHEN {d} = {least} THEN {_descend_sql(c, p)}"
        for d, c, p in zip(draws, node.children, paths, strict=True)
    )
    return f"CASE {cases} END"


def oracle_sql(n_shards: int = BASE_SHARDS) -> str:
    """DuckDB SQL for ``assign_shards`` with equal weights (CRC-32 bit by bit
    from its polynomial, as DuckDB has no function for it)."""
    return f"""
WITH RECURSIVE crc_steps(i, c, step) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8),
keyed AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS body FROM documents),
placed AS (
  SELECT doc_id, k,
    (strlen(body) + 1)::BIGINT AS size,
    xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x'||x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))::BIGINT AS text_crc32,
    {_descend_sql(topology(n_shards))}::INTEGER AS shard,
    {_descend_sql(topology(n_shards + 1))}::INTEGER AS grown_shard,
    ('0x'||substr(md5(k||'|slot'),1,13))::BIGINT AS h
  FROM keyed, crc_table)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot,
  grown_shard
FROM placed"""
