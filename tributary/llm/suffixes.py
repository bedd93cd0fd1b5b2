"""Repeated passages by difference-cover suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
smaller doc_id, or earlier in the same document) is removed. The suffixes that
can share such a string are brought together, sorted by the difference-cover
algorithm, and neighbours in the sorted order are compared.

1. Texts that occur more than once are copies of their first document: their
   copies of ``LENGTH`` bytes and more are covered whole.
2. Each window of ``LENGTH`` bytes is named by the smallest hash of the
   ``GRAM``-byte strings in it. Equal windows have equal names, so a name that
   occurs in one run of windows only needs no sorting. Successive windows of
   one name form a run. In a task, runs with equal bytes are one run; the
   later ones are covered.
3. The runs of repeated names are dealt by name. A task takes several names at
   a time, joins the bytes of their distinct runs and sorts the suffixes: the
   triples at positions 1 and 2 modulo 3 are sorted and named, the names are
   sorted by recursion until they differ or stand for ``LENGTH`` bytes, the
   remaining suffixes are merged in by their first symbol and the rank of the
   next suffix. Neighbouring suffixes that begin in a window are compared on
   ``LENGTH`` bytes; in each class of equal ones all but the first are covered.
4. Covered windows go back to their documents as spans.

Texts are shuffled once and that exchange is read by all three passes over
them; sorted strings never leave their task.

Edge cases: a null text is empty; texts shorter than ``LENGTH`` bytes keep all;
documents that repeat a doc_id are ordered by a hash of their text, and rows
that repeat doc_id and text are one document with one result; a null doc_id
comes before all others; an empty table gives an empty result; other columns
are ignored by ``find_repeats`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import mix64, shuffle_partitions, ship_package, stage_table, tidy

LENGTH = 100
GRAM = 32
#: Grams of a window.
SPAN = LENGTH - GRAM + 1
#: Windows hashed at a time in a long text.
PIECE = 1 << 21
#: Bytes of runs sorted together; one name's runs always are.
SORT_BYTES = 1 << 19
#: Distinct runs of one name that are sorted together. The runs of a more
#: frequent name are dealt by the hashes of their windows, to so many parts that
#: each gets about as many runs (a run has some SPAN / 2 windows, and goes to
#: the part of each).
HOT_RUNS = 16_384
#: Runs of a task compared with each other before they are dealt.
LOCAL_RUNS = 1 << 18


# --- names and runs ------------------------------------------------------------


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position (``gram`` a power of 2)."""
    h = mix64(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < gram:
        n = len(h) - step
        a, b = h[:n], h[step:]
        h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        step *= 2
    return mix64(h)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    step, out = 1, values
    while 2 * step <= width:
        out = np.minimum(out[: len(out) - step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, start, number of windows, named twice) of the runs of a text.

    A run is named twice if the gram of its name occurs more than once in it;
    only then can two windows of the run be equal.
    """
    names, starts, sizes, twice = [], [], [], []
    everything = np.frombuffer(data, dtype=np.uint8)
    total = len(data) - LENGTH + 1
    for at in range(0, total, PIECE):
        piece = everything[at : min(at + PIECE, total) + LENGTH - 1]
        grams = gram_hashes(piece)
        window = sliding_minimum(grams, SPAN)
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        name, size = window[first], np.diff(np.append(first, len(window)))
        # Grams that name a window: equal to the largest minimum over them.
        around = np.concatenate([np.zeros(SPAN - 1, np.uint64), window, np.zeros(SPAN - 1, np.uint64)])
        naming = np.flatnonzero(grams == ~sliding_minimum(~around, SPAN))
        values, number = np.unique(grams[naming], return_inverse=True)
        keys = np.sort((number.astype(np.int64) << 32) | naming)
        low = (np.searchsorted(values, name).astype(np.int64) << 32) | first
        found = np.searchsorted(keys, low + size + SPAN - 1) - np.searchsorted(keys, low)
        names.append(name.view(np.int64))
        starts.append(first + at)
        sizes.append(size)
        twice.append(found > 1)
    if not names:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(bool)
    return np.concatenate(names), np.concatenate(starts), np.concatenate(sizes), np.concatenate(twice)


def window_parts(content: bytes, parts: int) -> list[int]:
    """Parts that the windows of a run fall into by a hash of their bytes."""
    half = 1 << ((LENGTH - 1).bit_length() - 1)  # two overlapping grams span a window
    grams = gram_hashes(np.frombuffer(content, dtype=np.uint8), half)
    windows = len(content) - LENGTH + 1
    hashes = mix64(grams[:windows] ^ (grams[LENGTH - half : LENGTH - half + windows] * np.uint64(3)))
    return np.unique(hashes % np.uint64(parts)).tolist()


# --- difference-cover suffix sorting ---------------------------------------------


def _packed(*columns: np.ndarray) -> np.ndarray:
    """One unsigned key per row that orders like the columns."""
    key, bits = columns[0].astype(np.uint64), int(columns[0].max(initial=0)).bit_length()
    for column in columns[1:]:
        more = int(column.max(initial=0)).bit_length()
        if bits + more > 64:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            bits = int(key.max(initial=0)).bit_length()
        key = (key << np.uint64(more)) | column.astype(np.uint64)
        bits += more
    return key


def suffix_order(symbols: np.ndarray, length: int = LENGTH, stands_for: int = 1) -> np.ndarray:
    """Positions of ``symbols`` (integers from 1) in the order of their suffixes.

    Each symbol stands for ``stands_for`` characters. Suffixes that agree on
    ``length`` characters or more may stand in any order, but together.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(symbols[i:])), dtype=np.int64)
    s = np.concatenate([symbols.astype(np.int64), np.zeros(3, dtype=np.int64)])
    zero, one, two = np.arange(0, n, 3), np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triples = _packed(s[sample], s[sample + 1], s[sample + 2])
    distinct, names = np.unique(triples, return_inverse=True)
    if len(distinct) == len(sample) or 3 * stands_for >= length:
        by_rank = np.argsort(names, kind="stable")
    else:
        # The names of class 1, an end mark, the names of class 2.
        text = np.concatenate([names[: len(one)] + 2, [1], names[len(one) :] + 2])
        order = suffix_order(text, length, 3 * stands_for)
        order = order[order != len(one)]
        by_rank = np.where(order < len(one), order, order - 1)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[by_rank]] = np.arange(1, len(sample) + 1)
    # Remaining suffixes: by their first symbol and the rank of the next one.
    own = _packed(s[zero], rank[zero + 1])
    rest = zero[np.argsort(own, kind="stable")]
    # Merge: against class 1 by (symbol, rank), against class 2 by (symbol,
    # symbol, rank); all the ranks are those of sampled suffixes.
    width = np.uint64(int(rank.max()).bit_length())

    def pair(at: np.ndarray) -> np.ndarray:
        return (s[at].astype(np.uint64) << width) | rank[at + 1].astype(np.uint64)

    both = _packed(s[np.concatenate([rest, two])], s[np.concatenate([rest, two]) + 1])
    if int(both.max(initial=0)).bit_length() + int(width) > 64:
        both = np.unique(both, return_inverse=True)[1].astype(np.uint64)
    triple = (both << width) | rank[np.concatenate([rest, two]) + 2].astype(np.uint64)
    before = np.searchsorted(np.sort(pair(one)), pair(rest), side="left")
    before = before + np.searchsorted(np.sort(triple[len(rest) :]), triple[: len(rest)], side="left")
    # Among suffixes that agree on ``length`` characters the two counts may
    # disagree; such suffixes are neighbours, so the larger count serves both.
    before = np.maximum.accumulate(before)
    out = np.empty(n, dtype=np.int64)
    place = before + np.arange(len(rest))
    out[place] = rest
    others = np.ones(n, dtype=bool)
    others[place] = False
    out[others] = sample[by_rank]
    return out


def same_prefix(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Do the ``length`` bytes at each position equal those at the one before?"""
    same = np.zeros(len(at), dtype=bool)
    left, right, rows = at[:-1], at[1:], np.arange(1, len(at))
    for offset in range(0, length, 4):
        if not len(rows):
            return same
        alike = np.ones(len(rows), dtype=bool)
        for j in range(offset, min(offset + 4, length)):
            alike &= data[left + j] == data[right + j]
        left, right, rows = left[alike], right[alike], rows[alike]
    same[rows] = True
    return same


def covered_windows(contents: list[bytes], sizes: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """For distinct runs in ``contents`` with ``sizes`` windows each, and the
    rank ``places`` of each run's position: which windows also start earlier."""
    data = np.frombuffer(b"\x00".join(contents) + bytes(LENGTH), dtype=np.uint8)
    lengths = np.array([len(c) + 1 for c in contents], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order = suffix_order(data[: len(data) - LENGTH].astype(np.int64) + 1)
    # Number of the run and window at each position; -1 behind the windows.
    key = np.full(len(data), -1, dtype=np.int64)
    at = np.repeat(offsets, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    key[at] = (np.repeat(places, sizes) << 32) | (at - np.repeat(offsets, sizes))
    order = order[key[order] >= 0]
    first = np.flatnonzero(~same_prefix(data, order))
    least = np.repeat(np.minimum.reduceat(key[order], first), np.diff(np.append(first, len(order))))
    covered = np.zeros(len(data), dtype=bool)
    covered[order] = key[order] > least
    return [covered[o : o + n] for o, n in zip(offsets, sizes, strict=True)]


def spans_of(mask: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Byte spans that the marked windows of a run cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [(start + int(a), start + int(b) - 1 + LENGTH) for a, b in zip(edge[::2], edge[1::2], strict=True)]


# --- the job ------------------------------------------------------------------------

_RUN = "name long, d long, k long, run long"
_SPAN = "d long, k long, s long, e long"


def pack_run(start: np.ndarray, windows: np.ndarray, twice: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """A run in one long: start (below 2^31, as a text has fewer
    bytes), windows (below 2^30, as a run ends with its piece), named twice, covered."""
    return (start << 32) | (windows << 2) | (twice.astype(np.int64) << 1) | covered.astype(np.int64)


def unpack_run(run: int) -> tuple[int, int, bool, bool]:
    return run >> 32, (run & 0xFFFFFFFF) >> 2, bool(run & 2), bool(run & 1)


def _batch(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


@tidy
def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the texts (d, k, text). Of runs with equal bytes in a task the
    later ones are covered whole; they travel under a name of their own."""
    held: list[tuple] = []
    count = 0

    def flush() -> pa.RecordBatch:
        name, content, d, k, start, windows, twice = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((start, k, d, content, name))
        name, content, d, k, start, windows, twice = (c[order] for c in (name, content, d, k, start, windows, twice))
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (content[1:] != content[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        # A repeated row of the same document is not later than itself.
        covered = (d != d[first]) | (k != k[first]) | (start != start[first])
        own = mix64((k ^ start).view(np.uint64)).view(np.int64)
        return _batch(
            ["name", "d", "k", "run"], [np.where(covered, own, name), d, k, pack_run(start, windows, twice, covered)]
        )

    for batch in batches:
        for d, k, text in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), strict=True):
            data = text.as_py().encode()
            name, start, windows, twice = runs(data)
            if not len(name):
                continue
            held.append((name, _content_hashes(data, start, windows), np.full(len(name), d), np.full(len(name), k), start, windows, twice))
            count += len(name)
            if count >= LOCAL_RUNS:
                yield flush()
                held.clear()
                count = 0
    if held:
        yield flush()


def _content_hashes(data: bytes, start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """128-bit digests would not fit a column; 64 bits of a keyed hash, together
    with the 64-bit name, tell contents apart."""
    import xxhash

    return np.array(
        [xxhash.xxh3_64_intdigest(data[s : s + n + LENGTH - 1]) for s, n in zip(start.tolist(), windows.tolist(), strict=True)],
        dtype=np.uint64,
    )


def part_names(name: int, parts: list[int]) -> list[int]:
    seeds = np.array(parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    return mix64(seeds ^ np.array([name], dtype=np.int64).view(np.uint64)).view(np.int64).tolist()


@tidy
def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, d, k, start, windows, twice, content) of the chosen runs of each
    text; covered runs pass without content.

    Runs of a hot name are copied to the parts that their windows fall into.
    Equal windows meet in their part; what else of a run comes along there is
    compared too, which finds nothing that isn't so.
    """
    for batch in batches:
        out: list[tuple] = []
        for d, k, text, chosen in zip(*batch.columns, strict=True):
            data = text.as_py().encode()
            d, k = d.as_py(), k.as_py()
            for r in chosen.as_py():
                start, windows, twice, covered = unpack_run(r["run"])
                content = None if covered else data[start : start + windows + LENGTH - 1]
                names = [r["name"]]
                if r["n"] > HOT_RUNS and not covered:
                    parts = -(-r["n"] * SPAN // (2 * HOT_RUNS))
                    names = part_names(r["name"], window_parts(content, parts))
                out.extend((name, d, k, start, windows, twice, content) for name in names)
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        types = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["name", "d", "k", "start", "windows", "twice", "content"],
        )


@tidy
def _sort_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans covered in runs that come sorted by name."""
    found: list[tuple[int, int, int, int]] = []
    group: list[tuple] = []  # runs of the name being read
    pending: list[tuple] = []  # distinct runs of finished names, to sort together
    size = 0

    def finish() -> None:
        """Equal runs of one name become one; the rest waits for the sorting."""
        nonlocal size
        first: dict[bytes, tuple] = {}
        for run in sorted(group, key=lambda r: r[:3]):  # d, k, start
            d, k, start, windows, _, content = run
            known = first.setdefault(content, run)
            if known[:3] != run[:3]:
                found.append((d, k, start, start + windows - 1 + LENGTH))
        group.clear()
        if len(first) > 1 or next(iter(first.values()))[4]:
            pending.extend(first.values())
            size += sum(map(len, first))

    def sort() -> None:
        nonlocal size
        pending.sort(key=lambda r: r[:3])
        sizes = np.array([r[3] for r in pending], dtype=np.int64)
        masks = covered_windows([r[5] for r in pending], sizes, np.arange(len(pending)))
        for (d, k, start, *_), mask in zip(pending, masks, strict=True):
            found.extend((d, k, s, e) for s, e in spans_of(mask, start))
        pending.clear()
        size = 0

    def spans() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [()] * 4
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["d", "k", "s", "e"])

    now = None
    for batch in batches:
        name, d, k, start, windows = (c.to_numpy().tolist() for c in batch.columns[:5])
        twice = batch.column(5).to_pylist()
        for i, content in enumerate(batch.column(6)):
            data = content.as_py()
            if data is None:
                found.append((d[i], k[i], start[i], start[i] + windows[i] - 1 + LENGTH))
                continue
            if name[i] != now and group:
                finish()
                if size >= SORT_BYTES:
                    sort()
            now = name[i]
            group.append((d[i], k[i], start[i], windows[i], twice[i], data))
        if len(found) > 100_000:
            yield spans()
    if group:
        finish()
    if pending:
        sort()
    yield spans()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans of overlapping or touching ones."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remaining(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(data[at:s])
        at = e
    return b"".join([*parts, data[at:]])


def keyed(docs: DataFrame) -> DataFrame:
    """(d, k, k2, text): position of a document in the order, and its text's keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
        F.xxhash64(text).alias("k"),
        F.xxhash64(F.lit("second"), text).alias("k2"),
        text.alias("text"),
    )


def first_texts(rows: DataFrame) -> DataFrame:
    """One row per distinct text: its first document."""
    return rows.groupBy("k", "k2").agg(F.min("d").alias("d"), F.max(F.octet_length("text")).alias("n"))


def repeated_spans(rows: DataFrame, firsts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first documents' (d, k, text), and (d, k, s, e) covered in them."""
    partitions = shuffle_partitions(rows.sparkSession)
    dealt = rows.select("d", "k", "text").repartition(partitions, "d", "k")
    long = firsts.where(F.col("n") >= LENGTH).select("d", "k")
    texts = dealt.join(long, ["d", "k"], "left_semi").select("d", "k", "text")
    found = texts.mapInArrow(_local_runs, _RUN)
    same = Window.partitionBy("name")
    covered = F.col("run").bitwiseAND(1) != 0
    twice = F.col("run").bitwiseAND(2) != 0
    repeated = (
        found.withColumn("n", F.count(F.when(~covered, True)).over(same))
        .where((F.col("n") > 1) | twice | covered)
        .groupBy("d", "k")
        .agg(F.collect_list(F.struct("name", "run", "n")).alias("chosen"))
    )
    contents = texts.join(repeated, ["d", "k"]).mapInArrow(
        _contents, "name long, d long, k long, start long, windows long, twice boolean, content binary"
    )
    spans = (
        contents.repartition(partitions, "name").sortWithinPartitions("name").mapInArrow(_sort_names, _SPAN)
    )
    return texts, spans


def _by_document(spans: DataFrame) -> DataFrame:
    return spans.groupBy("d", "k").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def find_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    ship_package(docs.sparkSession)
    rows = keyed(docs)
    firsts = stage_table(first_texts(rows), "first-texts")
    texts, spans = repeated_spans(rows, firsts)

    @tidy
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, sha = [], [], []
            for text, own in zip(batch.column(2), batch.column(3), strict=True):
                data, cut = text.as_py().encode(), merged([(x["s"], x["e"]) for x in own.as_py() or ()])
                removed.append(sum(e - s for s, e in cut))
                count.append(len(cut))
                sha.append(hashlib.sha256(remaining(data, cut)).hexdigest())
            yield _batch(["d", "k", "n_removed", "n_spans", "sha"], [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())])

    judged = (
        texts.join(_by_document(spans), ["d", "k"], "left")
        .mapInArrow(digest, "d long, k long, n_removed long, n_spans long, sha string")
        .dropDuplicates(["d", "k"])
    )
    judged = stage_table(judged, "judged-texts")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long")
    # A copy of an earlier document: all of it, if it is long enough.
    base = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("k"),
        F.xxhash64(F.lit("second"), text).alias("k2"), size.alias("n_bytes"),
        F.when(size < LENGTH, F.sha2(text.cast("binary"), 256)).alias("short_sha"),
    )
    first = firsts.select(F.col("k").alias("_k"), "k2", F.col("d").alias("_first"))
    later = (F.col("n_bytes") >= LENGTH) & (F.col("d") != F.col("_first"))
    return (
        base.join(first, (base["k"] == first["_k"]) & (base["k2"] == first["k2"]))
        .join(judged.withColumnsRenamed({"d": "_d", "k": "_jk"}), F.expr("d = _d and k = _jk"), "left")
        .select(
            "doc_id", "n_bytes",
            F.when(later, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(later, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(later, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("short_sha", "sha")).alias("kept_sha256"),
        )
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated bytes, with all their columns.

    Bytes of a character that is cut in two go with the removed part;
    ``n_chars``, where it is a column, follows the text.
    """
    ship_package(docs.sparkSession)
    rows = keyed(docs)
    firsts = stage_table(first_texts(rows), "first-texts")
    _, spans = repeated_spans(rows, firsts)
    cuts = _by_document(spans)
    # Copies of an earlier document, found by their keys alone.
    first = firsts.where(F.col("n") >= LENGTH).select("k", "k2", F.col("d").alias("first"))
    later = rows.select("d", "k", "k2").distinct().join(first, ["k", "k2"]).where(F.col("d") != F.col("first"))
    marks = cuts.select("d", "k", "spans", F.lit(False).alias("later")).unionByName(
        later.select("d", "k", F.lit(None).cast(cuts.schema["spans"].dataType).alias("spans"), F.lit(True).alias("later"))
    )
    marks = stage_table(marks, "covered-spans")
    # The only exchange of whole rows; packed, so no name of theirs can clash.
    text = F.coalesce(F.col("text"), F.lit(""))
    place = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("k"),
    )
    joined = place.join(marks, ["d", "k"], "left").select("row", "later", "spans")
    at = docs.columns.index("text")
    n_chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    @tidy
    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, kept = batch.column(0).flatten(), []
            for text, later, cut in zip(columns[at], batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                if later.as_py():
                    text = ""
                elif cut.as_py():
                    spans = merged([(x["s"], x["e"]) for x in cut.as_py()])
                    text = remaining((text or "").encode(), spans).decode("utf-8", errors="ignore")
                kept.append(text)
            columns[at] = pa.array(kept, pa.string())
            if n_chars is not None:
                columns[n_chars] = pa.array([None if t is None else len(t) for t in kept], pa.int64()).cast(columns[n_chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in batch.schema.field(0).type])

    return joined.mapInArrow(shorten, docs.schema)
