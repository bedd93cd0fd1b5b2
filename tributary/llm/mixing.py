"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a token budget: the sources in code-point order (null last)
weigh 5, 2, 1, repeating, and share ``SHARE`` times all words; a target stops
at ``MAX_EPOCHS`` times its source's size, and the excess is reshared by
weight until no target is above its stop. Whole epochs of a source come first.
The rest of the budget is filled by weighted sampling without replacement:
every document draws the key -ln(u) / w, with u from a hash of its doc_id and
w its quality weight, and the documents of the source are taken in the order
of their keys while a document's middle lies within the budget (the document
on the border is taken if that brings the sum nearer to the target).

The prefix sums never order a source in one task. Keys fall into ``BUCKETS``
ranges; sums per (source, range) find the range that holds the border, ranges
before it are taken whole, and only the rows of that one range are ordered.

Quality weight: 0.05 + 0.95 * share of letters in the text (1.0 for no text).

Edge cases: a null or empty text has size 0 and is never counted; a null
source is a source of its own, the last; rows that repeat a doc_id and a size
share one decision; sources without words have target 0; an empty table gives
an empty result; ``mix`` ignores other columns, ``mixed_documents`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD, hash52, key_text, n_words, stage_table, unit

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
BUCKETS = 4096
#: Most sources whose plan (one row of some 100 bytes each) is broadcast.
BROADCAST_SOURCES = 20_000
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """Weight in [0.05, 1] from the share of letters."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    share = letters / F.length(text)
    return F.when(F.length(text) > 0, F.lit(0.05) + F.lit(0.95) * share).otherwise(F.lit(1.0))


def sized(docs: DataFrame, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, _key): all that the mix needs of a document."""
    u = unit(hash52(F.lit(seed), key_text(F.col("doc_id"))))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        (-F.log(u) / quality_weight(F.col("text"))).alias("_key"),
        *keep,
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, _epochs, _rest.

    The stops are reached in the order of stop / weight, so the fixed point of
    the resharing is one pass over the sources in that order: with the sources
    before k at their stops, the level of k is (total - their stops) / (weights
    from k on); k is at its stop if stop / weight <= level. The windows run
    over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]),
        ((F.row_number().over(position) - 1) % len(WEIGHTS) + 1).cast("int"),
    )
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    stops = (
        per.withColumn("_w", weight)
        .withColumn("_stop", F.col("source_size") * F.lit(MAX_EPOCHS))
        .withColumn("_ratio", F.col("_stop") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(SHARE))
        .withColumn(
            "_stopped",
            F.coalesce(F.sum("_stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("_open", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_total") - F.col("_stopped")) / F.col("_open"))
        .withColumn("_full", F.col("_ratio") <= F.col("_level"))
        .withColumn("_lambda", F.min(F.when(~F.col("_full"), F.struct("_ratio", "_level"))).over(everything).getField("_level"))
    )
    target = F.when(F.col("_full"), F.col("_stop").cast("double")).otherwise(
        F.col("_lambda") * F.col("_w")
    )
    return (
        stops.withColumn("target", target)
        .withColumn(
            "_epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
        )
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .select("source", "source_size", "target", "_epochs", "_rest")
    )


def _rank() -> Column:
    """Order of a source's documents; null doc_ids come first."""
    return F.struct(F.col("_key").alias("k"), F.col("doc_id").cast("string").alias("d"), F.col("size").alias("s"))


def _range(buckets: int) -> Column:
    # -expm1(-key) is a monotone map of the keys to (0, 1).
    return F.least(F.floor(-F.expm1(-F.col("_key")) * F.lit(buckets)), F.lit(buckets - 1)).cast("int")


def source_plan(sizes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per source: its target, whole epochs, and the last document of
    the fractional selection (``_cut_b``: its key range, ``_cut``: its rank).

    ``sizes`` is (doc_id, source, size, _key) and is read twice.
    """
    rows = sizes.withColumn("_b", _range(buckets))
    per_range = rows.groupBy("source", "_b").agg(F.sum("size").alias("_s"))
    targets = source_targets(per_range.select("source", F.col("_s").alias("size")))
    cumulative = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    border = (
        per_range.withColumn("_upto", F.sum("_s").over(cumulative))
        .join(targets.select(F.col("source").alias("_t_source"), "_rest"), F.expr("source <=> _t_source"))
        .where((F.col("_upto") - F.col("_s") <= F.col("_rest")) & (F.col("_upto") > F.col("_rest")))
        .select(
            F.col("source").alias("_b_source"), F.col("_b").alias("_cut_b"),
            (F.col("_upto") - F.col("_s")).alias("_before"), F.col("_rest").alias("_b_rest"),
        )
    )
    inside = Window.partitionBy("source").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        rows.join(border, F.expr("source <=> _b_source and _b = _cut_b"))
        .withColumn("_rank", _rank())
        .withColumn("_upto", F.col("_before") + F.sum("size").over(inside))
        .groupBy("source")
        .agg(
            F.max("_cut_b").alias("_cut_b"),
            F.max(
                F.when(
                    (F.col("_upto") - F.col("size") / 2 <= F.col("_b_rest")) & (F.col("_b_rest") > 0),
                    F.col("_rank"),
                )
            ).alias("_cut"),
        )
        .withColumnRenamed("source", "_c_source")
    )
    return targets.join(cut, F.expr("source <=> _c_source"), "left").select(
        F.col("source").alias("_plan_source"), "source_size", "target", "_epochs", "_cut_b", "_cut"
    )


def _epochs_taken(buckets: int) -> Column:
    b = _range(buckets)
    more = (b < F.col("_cut_b")) | ((b == F.col("_cut_b")) & (_rank() <= F.col("_cut")))
    return F.col("_epochs") + F.when(more, 1).otherwise(0)


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the plan of their source.

    The plan is counted: up to ``BROADCAST_SOURCES`` rows it is broadcast, so
    the rows stay where they are and a hot source needs no care; beyond that
    both sides are shuffled and adaptive execution splits a hot source.
    """
    plan = stage_table(plan, "mix-plan")
    few = plan.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(plan) if few else plan, F.expr("source <=> _plan_source"))


def mix(docs: DataFrame, seed: str = SEED, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), source, epochs."""
    sizes = stage_table(sized(docs, seed), "mix-sizes")
    epochs = _epochs_taken(buckets)
    return _with_plan(sizes, source_plan(sizes, buckets)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * epochs).cast("long").alias("taken"),
        "source",
        epochs.cast("int").alias("epochs"),
    )


def mixed_documents(docs: DataFrame, seed: str = SEED, buckets: int = BUCKETS) -> DataFrame:
    """The mixed corpus with the input's columns: every document as often as
    the mix takes it (0 to ``MAX_EPOCHS`` times). Documents without words
    are never taken. The texts are not shuffled: the decision is made row by
    row against the plan of the row's source."""
    plan = source_plan(stage_table(sized(docs, seed), "mix-sizes"), buckets)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = sized(docs.withColumn("_row", row), seed, keep=("_row",))
    return (
        _with_plan(rows.where(F.col("size") > 0), plan)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), _epochs_taken(buckets).cast("int"))))
        .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
    )


def oracle_sql() -> str:
    """DuckDB SQL for doc_id, size, source_size, target, taken of ``mix``."""
    weights = "[" + ", ".join(f"{float(w)!r}" for w in WEIGHTS) + "]"
    return f"""
WITH sized AS (
  SELECT doc_id, source::VARCHAR AS source,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    -ln((('0x'||substr(md5('{SEED}|'||coalesce(doc_id::VARCHAR, '')),1,13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE WHEN length(text) > 0
          THEN 0.05 + 0.95 * (length(regexp_replace(text, '\\P{{L}}+', '', 'g'))::DOUBLE / length(text)) ELSE 1.0 END AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (
  SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(WEIGHTS)} + 1] AS w,
    source_size * {MAX_EPOCHS} AS stop, (sum(source_size) OVER ()) * {SHARE}::DOUBLE AS total
  FROM per),
l AS (
  SELECT *, stop / w AS ratio,
    (total - coalesce(sum(stop) OVER (ORDER BY stop / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY stop / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size,
    CASE WHEN ratio <= level THEN stop::DOUBLE
      ELSE w * (SELECT arg_min(level, ratio) FROM l WHERE NOT ratio <= level) END AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
c AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c"""
