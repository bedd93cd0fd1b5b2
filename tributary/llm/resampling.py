"""Importance resampling toward a target distribution of hashed n-grams.

1. Words of a text are hashed (n-grams of ``n_grams`` consecutive words) into
   buckets; the arrays of buckets are staged with the row's own number.
2. A bucket's gain is the floored log ratio of its smoothed shares in the
   targets and in the documents. The gains (one number per bucket, a bound set
   by ``buckets``) form one constant array, and a document's weight is the
   floored mean of the array's entries at its buckets; Gumbel noise from a hash
   of the doc_id makes the top scores a draw without replacement.
3. The scores are persisted. The cutoff is found by bisection on the persisted
   numbers: exact count jobs, each for the ``2 ** LEVELS - 1`` midpoints that the
   next ``LEVELS`` halvings can reach, narrow the score, then among the rows tied
   on it the doc_id, then the length, then the row number.
4. The drawn rows are range-partitioned in the order of the draw; a row's rank
   is its place in its partition behind the rows of the partitions before.

No row is joined, no group is collected: a hot doc_id or a third of equal rows
is split by the row number, the last key of the order.

Edge cases: a null text has no words; a document without features weighs 0; a
null doc_id hashes as the empty text and comes last among ties; of rows that
tie on score and doc_id the one with more features comes first, and rows that
are equal in all that are interchangeable; with empty targets the gains follow
from the smoothing alone; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tributary.llm.common import key_text, shuffle_partitions, stage_table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10_000
N_GRAMS = (1, 1)
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Halvings that one count job serves.
LEVELS = 4


def words(text: Column) -> Column:
    """Words of a text as an array, A-Z lower-cased (null: none)."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))


def features(found: Column, n_grams: tuple[int, int]) -> Column:
    """All runs of consecutive words of the given lengths, joined by a blank."""
    least, most = n_grams
    if most == 1:
        return found

    def run_of(n: int):
        return lambda at: F.array_join(F.slice(found, at, n), " ")

    size, none = F.size(found), F.array().cast("array<string>")
    parts = []
    for n in range(least, most + 1):
        places = F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))
        parts.append(F.when(size >= n, F.transform(places, run_of(n))).otherwise(none))
    return F.concat(*parts)


def hashed(rows: DataFrame, n_grams: tuple[int, int], buckets: int, *keep: str) -> DataFrame:
    """``keep`` columns with ``n_words`` and the buckets of all features."""
    found = rows.select(*keep, words(F.col("text")).alias("found"))
    return found.select(
        *keep,
        F.size("found").cast("long").alias("n_words"),
        F.transform(features(F.col("found"), n_grams), lambda f: (F.crc32(f.cast("binary")) % buckets).cast("int")).alias("buckets"),
    )


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count()


def gains(own: DataFrame, targets: DataFrame, buckets: int) -> list[int]:
    """Gain of each bucket, from the (bucket, count) frames of both sides."""
    s, t = ({r.bucket: r["count"] for r in side.collect()} for side in (own, targets))  # one row per bucket
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [
        math.floor(1000.0 * math.log(((t.get(b, 0) + 1.0) * all_s) / ((s.get(b, 0) + 1.0) * all_t))) for b in range(buckets)
    ]


def floor_mean(total: Column, n: Column) -> Column:
    """Floored quotient of longs, exact."""
    return ((total - F.pmod(total, n)) / n).cast("long")


def scored(rows: DataFrame, gain: list[int], seed: str) -> DataFrame:
    """Staged rows with n_features, weight and score."""
    # One constant array, folded before the tasks read it.
    array = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(array, b))
    n = F.size("buckets").cast("long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key_text(F.col("doc_id"))).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")
    weight = F.when(n == 0, F.lit(0).cast("long")).otherwise(floor_mean(total, F.greatest(n, F.lit(1).cast("long"))))
    return rows.select(
        "row", "doc_id", "n_words", n.alias("n_features"), weight.alias("weight")
    ).withColumn("score", F.col("weight") + noise)


# --- the cutoff ------------------------------------------------------------------------

#: Columns of the order of the draw, which all rank from low to high.
ORDER = ("low", "no_id", "id", "short", "row")


def with_order(rows: DataFrame) -> DataFrame:
    """``ORDER``'s columns as longs; a null doc_id stands behind all others."""
    zero = F.lit(0).cast("long")
    return rows.withColumns(
        {
            "low": -F.col("score"),
            "no_id": F.col("doc_id").isNull().cast("long"),
            "id": F.coalesce(F.col("doc_id").cast("long"), zero),
            "short": -F.col("n_features"),
        }
    )


def midpoints(low: int, high: int, levels: int) -> list[int]:
    """The midpoints that ``levels`` halvings of low..high can reach."""
    if levels == 0 or low >= high:
        return []
    mid = (low + high) // 2
    return sorted({*midpoints(low, mid, levels - 1), mid, *midpoints(mid + 1, high, levels - 1)})


def smallest_reaching(rows: DataFrame, name: str, wanted: int) -> tuple[int, int]:
    """(v, rows below v): the smallest value of a long column such that at
    least ``wanted`` (1 or more) rows are at most v, by bisection."""
    low, high = rows.agg(F.min(name), F.max(name)).first()
    below = 0
    while low < high:
        mids = midpoints(low, high, LEVELS)
        counts = rows.agg(*[F.count_if(F.col(name) <= m).alias(f"c{i}") for i, m in enumerate(mids)]).first()
        for m, n in zip(mids, counts, strict=True):
            # The midpoints rise: those not reached push the lower end, the
            # first that is reached ends the interval.
            if n >= wanted:
                high = m
                break
            low, below = m + 1, n
    return low, below


def cutoff(rows: DataFrame, wanted: int) -> dict[str, int]:
    """The last drawn row as values of ``ORDER``'s columns; fewer columns where
    all the rows that tie so far are drawn."""
    tied, out = rows, {}
    for name in ORDER:
        value, below = smallest_reaching(tied, name, wanted)
        out[name] = value
        wanted -= below
        tied = tied.where(F.col(name) == value)
        if tied.count() == wanted:
            break
    return out


def drawn_by(cut: dict[str, int]) -> Column:
    """Is a row at or before the cutoff?"""
    last = F.lit(True)
    for name, value in reversed(cut.items()):
        last = (F.col(name) < value) | ((F.col(name) == value) & last)
    return last


def ranked(drawn: DataFrame) -> DataFrame:
    """The drawn rows with their ranks (1, 2, ...) in the order of the draw."""
    parts = shuffle_partitions(drawn.sparkSession)
    dealt = stage_table(
        drawn.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id()), "resample-drawn"
    )
    sizes: list[Row] = dealt.groupBy("part").count().orderBy("part").collect()  # one per partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], before))
        before += r["count"]
    first = drawn.sparkSession.createDataFrame(offsets, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*ORDER))
    return dealt.withColumn("place", place).join(F.broadcast(first), "part").withColumn("rank", F.col("before") + F.col("place"))


def resample(
    docs: DataFrame,
    targets: DataFrame,
    n_grams: tuple[int, int] = N_GRAMS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row.

    Of the N documents with at least ``min_words`` words, the floor(percent * N
    / 100) of the highest scores are drawn. ``docs`` and ``targets`` need the
    column ``text``, ``docs`` a numeric ``doc_id`` too.
    """
    plain = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    rows = stage_table(hashed(plain, n_grams, buckets, "row", "doc_id"), "resample-buckets")
    gain = gains(bucket_counts(rows), bucket_counts(hashed(targets, n_grams, buckets)), buckets)
    every = stage_table(scored(rows, gain, seed), "resample-scores")
    keyed = with_order(every)
    able = keyed.where(F.col("n_words") >= min_words)
    wanted = percent * able.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return keyed.select(*columns, unranked)
    is_drawn = (F.col("n_words") >= min_words) & drawn_by(cutoff(able, wanted))
    return ranked(keyed.where(is_drawn)).select(*columns, F.col("rank").cast("long")).unionByName(
        keyed.where(~is_drawn).select(*columns, unranked)
    )


def oracle_sql() -> str:
    """DuckDB SQL for ``resample`` with its defaults (CRC-32 from its polynomial)."""
    return f"""
WITH RECURSIVE crc_steps(i, c, step) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM crc_steps WHERE step < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8),
own AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w
  FROM documents),
goal AS MATERIALIZED (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM benchmark),
own_words AS MATERIALIZED (SELECT r, unnest(w) AS word FROM own),
goal_words AS MATERIALIZED (SELECT unnest(w) AS word FROM goal),
hashed AS MATERIALIZED (
  SELECT word, xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x'||x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))::BIGINT % {BUCKETS} AS bucket
  FROM (SELECT word FROM own_words UNION SELECT word FROM goal_words), crc_table),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM own_words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM goal_words JOIN hashed USING (word) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*)::DOUBLE FROM own_words) AS all_s, (SELECT count(*)::DOUBLE FROM goal_words) AS all_t),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000.0 * ln(((coalesce(t, 0) + 1) * (all_s + {BUCKETS})) / ((coalesce(s, 0) + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), sizes),
total AS (SELECT r, sum(gain)::BIGINT AS g, count(*) AS n FROM own_words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT own.r, doc_id, coalesce(n, 0)::BIGINT AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END::BIGINT AS weight,
    ('0x'||substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM own LEFT JOIN total USING (r)),
noisy AS (
  SELECT r, doc_id, n_features, weight,
    weight + floor(-1000.0 * ln(-ln((h + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM scored),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features DESC, r) AS place,
    count(*) OVER () AS n
  FROM noisy WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= {PERCENT} * n // 100 THEN place END::BIGINT AS rank
FROM noisy LEFT JOIN placed USING (r)"""
