"""Quality rules by distribution divergence from language references.

References: for each language, the histogram of character classes and of the
``COMMON_WORDS`` most frequent words (plus one bin for all others), counted
over every distinct text of the language once, so that copies do not shift it,
and scaled to the words of all its rows. A document is compared with the references by the
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1); the
nearest reference counts, so a wrong or missing ``lang`` does no harm. It is
rejected if its character classes or its common words are too far from all
references; texts below the minimum lengths are too short to compare and keep
their base verdict. The common words are compared in groups that the text's
length can fill, up to the distance that so many words drawn from the
reference have by chance, plus a margin. A reference gives no verdict where
even a text without its common words would stay within that cut; documents of
such a language (by ``lang``, else by their characters) are not judged by
words. Every document is compared with the ``MAX_LANGUAGES`` references of most
words, and with that of its own ``lang`` if that is another one. Base rules: at least ``MIN_WORDS`` words, and at most
30 % of the words in repeated 8-word windows.

Edge cases: a null or empty text has no words and fails the base rules; a null
lang adds to no reference; with no reference at all only the base rules hold;
an empty table gives an empty result; repeated rows are judged alike.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections import Counter
from collections.abc import Collection, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD_RE, mix64, packed, ship_package, stage_table, tidy

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Words of a language's common-word histogram.
COMMON_WORDS = 64
#: Every document is compared with the references of the languages with most
#: words; references of other languages reach only their own documents.
MAX_LANGUAGES = 64
#: Minimum lengths for the two comparisons.
MIN_CHARS_TO_COMPARE = 150
MIN_WORDS_TO_COMPARE = 40
#: Largest distance of a kept document by characters.
MAX_CHAR_DISTANCE = 0.25
#: By words: what documents of a language differ beyond chance (as a distance),
#: and how many standard deviations of the chance part are allowed.
WORD_MARGIN = 0.3
WORD_DEVIATIONS = 4
#: Words of a group of common words that a text of the reference has on average.
GROUP_WORDS = 5
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
N_CLASSES = 11
#: References of own languages that a task holds.
CACHE_LANGUAGES = 256
#: Distinct words that a task holds per language before it hands them on.
_FLUSH = 100_000
#: Column of the reference of a document's own language.
OWN = "_own_reference"
#: Digests of texts that a task holds before it hands their copies on.
_FLUSH_TEXTS = 200_000

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


@cache
def class_table() -> np.ndarray:
    """Class of every code point: 0 and 1 lower- and upper-case ASCII, 2 other
    lower-case, 3 other letters, 4 digits, 5 blanks, 6 line ends, 7 sentence
    punctuation, 8 symbols of the base rules, 9 other signs, 10 the rest."""
    by_category = {"L": 3, "N": 4, "Z": 5, "P": 9, "S": 9, "M": 10, "C": 10}
    table = np.array([by_category[unicodedata.category(chr(c))[0]] for c in range(0x110000)], dtype=np.uint8)
    lower = [c for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Ll"]
    table[lower] = 2
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[[9, 32]] = 5
    table[[10, 11, 12, 13]] = 6
    table[[ord(c) for c in PUNCTUATION]] = 7
    table[[ord(c) for c in SYMBOLS]] = 8
    return table


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(class_table()[points], minlength=N_CLASSES)


def common_form(word: str) -> str:
    """A word as the common-word histograms count it."""
    return word.lower().strip(PUNCTUATION)


def repeated_words(words: list[str], distinct: Collection[str]) -> int:
    """Words inside 8-word windows that occur twice or more in the text."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2 or len(distinct) == len(words):
        return 0
    ids = {w: i for i, w in enumerate(distinct, 1)}
    h = mix64(np.fromiter(map(ids.__getitem__, words), dtype=np.uint64, count=len(words)))
    window = np.zeros(n, dtype=np.uint64)
    for j in range(REPEAT_WINDOW):
        window = mix64(window ^ h[j : j + n]) + np.uint64(j + 1)
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + REPEAT_WINDOW, -1)
    return int((np.cumsum(cover) > 0).sum())


def base_figures(text: str, words: list[str], distinct: Collection[str]) -> tuple[int, int, int, int, int, bool]:
    lines = Counter(text.split("\n"))
    duplicates = sum(n - 1 for line, n in lines.items() if n > 1 and WORD_RE.search(line))
    repeated = repeated_words(words, distinct)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicates, repeated, failed


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def gain(a: np.ndarray) -> float:
        at = a > 0
        return float((a[at] * np.log2(a[at] / m[at])).sum())

    return float(np.sqrt(max(0.0, (gain(p) + gain(q)) / 2)))


class References:
    """Character and common-word histograms of the languages; ``sizes`` are the
    words that the histograms were counted over."""

    def __init__(
        self,
        chars: dict[str, list[int]],
        words: dict[str, dict[str, float]],
        totals: dict[str, int],
        sizes: dict[str, int] | None = None,
    ):
        self.chars = {k: np.array(v, dtype=float) for k, v in chars.items() if sum(v)}
        self.bins = {k: {w: i for i, w in enumerate(v)} for k, v in words.items()}
        self.words = {
            k: np.array([*v.values(), max(0, totals[k] - sum(v.values()))], dtype=float)
            for k, v in words.items()
            if totals[k]
        }
        self.sizes = totals if sizes is None else sizes
        self._groups: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, float]] = {}

    def with_own(self, own: References) -> References:
        """These references and ``own``."""
        joined = References({}, {}, {}, self.sizes | own.sizes)
        joined.chars, joined.bins, joined.words = self.chars | own.chars, self.bins | own.bins, self.words | own.words
        return joined

    def groups(self, language: str, n: int) -> tuple[np.ndarray, np.ndarray, float]:
        """First bins of the groups for texts of ``n`` words, the reference by
        group, and the distance of a text without any common word."""
        step = int(4 * np.log2(n))  # lengths in steps of 2^(1/4) have the same groups
        found = self._groups.get((language, step))
        if found is None:
            share = self.words[language] / self.words[language].sum()
            starts, filled = [0], 0.0
            for i, mean in enumerate(share[:-1] * 2 ** (step / 4)):
                if filled >= GROUP_WORDS:
                    starts.append(i)
                    filled = 0.0
                filled += mean
            if filled < GROUP_WORDS and len(starts) > 1:
                starts.pop()
            if len(share) > 1:
                starts.append(len(share) - 1)
            reference = np.add.reduceat(share, starts)
            without = np.zeros(len(reference))
            without[-1] = 1.0
            found = self._groups[language, step] = np.array(starts), reference, js_distance(without, reference)
        return found

    def cut(self, language: str, n: int) -> float | None:
        """Largest distance of a text of ``n`` words; None if the reference
        gives no verdict. By chance the divergence is a chi-square with a
        degree of freedom less than groups over 8 ln 2 times the words."""
        _, reference, without = self.groups(language, n)
        free = len(reference) - 1
        chance = (free + WORD_DEVIATIONS * np.sqrt(2 * free)) * (1 / n + 1 / self.sizes[language]) / (8 * np.log(2))
        cut = float(np.sqrt(chance + WORD_MARGIN**2))
        return cut if cut < without else None

    def compare(self, text: str, words: Counter, lang: str | None = None) -> tuple[float | None, float | None, bool]:
        """Distance to the nearest reference by characters and by words (the
        one that is least beyond its cut), and whether both are within."""
        n = words.total()
        by_char: dict[str, float] = {}
        if self.chars and len(text) >= MIN_CHARS_TO_COMPARE:
            counts = class_counts(text).astype(float)
            by_char = {k: js_distance(counts, ref) for k, ref in self.chars.items()}
        char = min(by_char.values(), default=None)
        near = char is None or char <= MAX_CHAR_DISTANCE
        if n < MIN_WORDS_TO_COMPARE:
            return char, None, near
        cuts = {k: self.cut(k, n) for k in self.words}
        own = [lang] if lang in cuts else [k for k in cuts if by_char.get(k, 0.0) <= MAX_CHAR_DISTANCE]
        if any(cuts[k] is None for k in own):
            return char, None, near
        forms: Counter = Counter()
        for w, times in words.items():
            forms[common_form(w)] += times
        least = word = None
        for language, cut in cuts.items():
            if cut is None:
                continue
            bins = self.bins[language]
            starts, reference, _ = self.groups(language, n)
            counts = np.zeros(len(bins) + 1)
            for form in forms.keys() & bins.keys():
                counts[bins[form]] = forms[form]
            counts[-1] = n - counts.sum()
            distance = js_distance(np.add.reduceat(counts, starts), reference)
            if least is None or distance - cut < least:
                least, word = distance - cut, distance
        return char, word, near and (least is None or least <= 0)


@tidy
def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, lang, text, copies): each text of a language once per task, packed,
    and a row without text for its further copies in the task."""
    seen: dict[bytes, int] = {}
    pack = zstandard.ZstdCompressor(level=1)
    types = (pa.binary(), pa.string(), pa.binary(), pa.int64())

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((),) * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "lang", "text", "copies"])

    def copies() -> pa.RecordBatch:
        rows = [(key, None, None, n) for key, n in seen.items() if n]
        seen.clear()
        return made(rows)

    for batch in batches:
        rows = []
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            if lang is None or not text:
                continue
            data = text.encode()
            key = hashlib.blake2b(lang.encode() + b"\0" + data, digest_size=16).digest()
            if key in seen:
                seen[key] += 1
            else:
                seen[key] = 0
                rows.append((key, lang, pack.compress(data), 1))
        yield made(rows)
        if len(seen) > _FLUSH_TEXTS:
            yield copies()
    yield copies()


@tidy
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bins of the distinct texts, of which all rows are in one task, and the
    words of all rows (kind "t")."""
    words: dict[str, Counter] = {}
    chars: dict[str, np.ndarray] = {}
    sizes: dict[bytes, tuple[str, int]] = {}
    copies: Counter = Counter()
    unpack = zstandard.ZstdDecompressor()

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else ((), (), (), ())
        types = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "kind", "bin", "n"]
        )

    def rows() -> pa.RecordBatch:
        found = [(lang, "w", w, n) for lang, c in words.items() for w, n in c.items()]
        found += [(lang, "c", str(i), int(n)) for lang, c in chars.items() for i, n in enumerate(c) if n]
        words.clear()
        chars.clear()
        return batch_of(found)

    for batch in batches:
        for key, lang, packed, n in zip(*batch.columns, strict=True):
            key = key.as_py()
            copies[key] += n.as_py()
            if key in sizes or not packed.is_valid:
                continue
            lang, text = lang.as_py(), unpack.decompress(packed.as_py()).decode()
            own = words.setdefault(lang, Counter())
            found = WORD_RE.findall(text)
            sizes[key] = lang, len(found)
            own.update(found)
            chars[lang] = chars.get(lang, 0) + class_counts(text)
            if len(own) > _FLUSH:
                yield rows()
    yield rows()
    totals: Counter = Counter()
    for key, (lang, n) in sizes.items():
        totals[lang] += n * copies[key]
    yield batch_of([(lang, "t", "", n) for lang, n in totals.items() if n])


def language_references(docs: DataFrame) -> References:
    """The references that every document is compared with."""
    return all_references(docs)[0]


def all_references(docs: DataFrame) -> tuple[References, DataFrame | None]:
    """Count every distinct text of a language. Only the histograms of
    ``MAX_LANGUAGES`` languages (at most ``COMMON_WORDS`` + ``N_CLASSES`` rows
    each) reach the driver; those of the others, if any, are a table (``OWN``).
    Texts are dealt by their digest, packed and once per task."""
    ship_package(docs.sparkSession)
    distinct = docs.selectExpr("cast(lang as string) as lang", "text").mapInArrow(
        _distinct, "key binary, lang string, text binary, copies long"
    )
    counted = distinct.repartition("key").mapInArrow(_counted, "lang string, kind string, bin string, n long")
    # Words as counted, e.g. without case and outer punctuation.
    form = F.when(F.col("kind") == "w", F.lower(F.btrim(F.col("bin"), F.lit(PUNCTUATION)))).otherwise(F.col("bin"))
    sums = counted.groupBy("lang", "kind", form.alias("bin")).agg(F.sum("n").alias("n"))
    # One pass: the total of a (lang, kind) and its most frequent bins.
    top = Window.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "bin")
    sums = stage_table(sums, "language-counts")
    words_of = F.sum(F.when(F.col("kind") == "w", F.col("n"))).alias("n")
    of_all = F.sum(F.when(F.col("kind") == "t", F.col("n"))).alias("n_all")
    totals = sums.where("kind != 'c'").groupBy("lang").agg(words_of, of_all).where("n > 0")
    largest = totals.orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES + 1).collect()
    if not largest:
        return References({}, {}, {}), None
    names = [r.lang for r in largest[:MAX_LANGUAGES]]
    ranked = (
        sums.where("kind = 'c' or kind = 'w' and bin != ''")
        .withColumn("r", F.row_number().over(top))
        .where(F.col("r") <= max(COMMON_WORDS, N_CLASSES))
    )
    rows = ranked.where(F.col("lang").isin(names)).orderBy("lang", "r").collect()
    references = references_of([(r.lang, r.kind, r.bin, r.n) for r in rows], {r.lang: (r.n, r.n_all) for r in largest[:MAX_LANGUAGES]})
    if len(largest) <= MAX_LANGUAGES:
        return references, None
    other = ranked.where(~F.col("lang").isin(names)).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("r", "kind", "bin", F.col("n").alias("times")))).alias("bins")
    )
    other = other.join(totals, "lang").select(
        F.col("lang").alias(OWN + "_lang"), F.to_json(F.struct("lang", "n", "n_all", "bins")).alias(OWN)
    )
    return references, stage_table(other, "language-references")


def references_of(rows: list[tuple[str, str, str, int]], totals: dict[str, tuple[int, int]]) -> References:
    """References from (lang, kind, bin, n), most frequent bins first, and the
    words of the distinct texts and of all rows."""
    chars: dict[str, list[int]] = {lang: [0] * N_CLASSES for lang in totals}
    words: dict[str, dict[str, float]] = {lang: {} for lang in totals}
    for lang, kind, found, times in rows:
        if kind == "c":
            chars[lang][int(found)] = times
        else:
            n, n_all = totals[lang]
            words[lang][found] = times * n_all / n
    return References(
        chars, words, {lang: n_all for lang, (_, n_all) in totals.items()}, {lang: n for lang, (n, _) in totals.items()}
    )


class OwnReferences:
    """The references for a document: the common ones and that of its language."""

    def __init__(self, common: References):
        self.common = common
        self.joined: dict[str, References] = {}

    def of(self, own: str | None) -> References:
        if own is None:
            return self.common
        found = self.joined.get(own)
        if found is None:
            if len(self.joined) >= CACHE_LANGUAGES:
                self.joined.clear()
            data = json.loads(own)
            rows = [(data["lang"], b["kind"], b["bin"], b["times"]) for b in data["bins"]]
            found = self.common.with_own(references_of(rows, {data["lang"]: (data["n"], data["n_all"])}))
            self.joined[own] = found
        return found


def with_references(docs: DataFrame) -> tuple[References, list[DataFrame]]:
    """The common references, and the documents with a column ``OWN`` more: the
    reference of a language that is not among those. Only documents of such
    languages, each below a share of 1 / ``MAX_LANGUAGES`` of the words, are
    joined (by broadcast or shuffle, as Spark finds the table's size)."""
    references, other = all_references(docs)
    none = F.lit(None).cast("string").alias(OWN)
    if other is None:
        return references, [docs.select("*", none)]
    lang = F.col("lang").cast("string")
    common = lang.isNull() | lang.isin([*references.sizes])
    joined = docs.where(~common).join(other, lang == F.col(OWN + "_lang"), "left").drop(OWN + "_lang")
    return references, [docs.where(common).select("*", none), joined]


def judge(text: str | None, references: References, lang: str | None = None) -> tuple:
    """Base figures, base verdict, the two distances, and the verdict."""
    text = text or ""
    words = WORD_RE.findall(text)
    counted = Counter(words)
    base = base_figures(text, words, counted)
    char, word, near = references.compare(text, counted, lang)
    return (*base, char, word, near and not base[-1])


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base figures, base_failed, char_distance, word_distance, kept.

    Two passes over the documents (count, then judge), one shuffle of packed
    texts, each once per task, and one of word counts, which are added up in
    each task before."""
    references, parts = with_references(docs.selectExpr("doc_id", "text", "cast(lang as string) as lang"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = OwnReferences(references)
        for batch in batches:
            cells = zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
            rows = [judge(text, known.of(own), lang) for text, lang, own in cells]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 9
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=_NAMES,
            )

    schema = f"doc_id {_type(docs, 'doc_id')}, {BASE}, char_distance double, word_distance double, kept boolean"
    return reduce(DataFrame.unionAll, [part.mapInArrow(run, schema) for part in parts])


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]


def _type(df: DataFrame, column: str) -> str:
    return dict(df.dtypes)[column]


def _lang(value: object) -> str | None:
    return None if value is None else str(value)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns; the verdict
    is made where the rows are read, so no text is shuffled."""
    row = packed(docs).alias("row")
    references, parts = with_references(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), row))
    names = docs.columns
    at, lang_at = names.index("text"), names.index("lang")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = OwnReferences(references)
        for batch in batches:
            columns = batch.column(0).flatten()
            cells = zip(columns[at], columns[lang_at], batch.column(1), strict=True)
            kept = [judge(t.as_py(), known.of(own.as_py()), _lang(lang.as_py()))[-1] for t, lang, own in cells]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(kept, pa.bool_()))

    return reduce(DataFrame.unionAll, [part.select("row", OWN).mapInArrow(run, docs.schema) for part in parts])
