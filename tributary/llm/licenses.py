"""License scans by conditional compression.

A text's candidate blocks are windows around its license words, wide enough
for the longest template before and after each, across lines. Each block is
compressed on its own and with every template as a zstandard raw dictionary;
templates are ranked by the bytes that they shorten the block by. They are
confirmed in that order by their exact wording, up to the first that holds: the
words of template and block are aligned, and a template holds if nearly all of its words stand in the block and none of its
deciding words (numbers but those of list items, license names) differs. What
is missing or added is reported, and what is left of the block beside the notice
is ranked anew until nothing holds. Where notices of different blocks overlap,
the one whose template saves most bytes of it counts.

One pass over the documents, without a shuffle; templates are a parameter.

Edge cases: a null or empty text has no candidates and no rows; a text without
license words costs a few substring searches; each found notice gives one row,
so a document may have several; repeated rows are reported each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tributary.llm.common import ship_package

# Wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Words that decide between licenses, besides numbers.
DECIDING = frozenset("apache mit gnu lesser affero mozilla cc by nc sa nd cc0 domain".split())
#: A text without any of these has no candidate block.
TRIGGERS = ("licens", "licenc", "permission", "redistribution", "public domain", "unencumbered")

#: Words to each side of the license words of a block, by those of the longest
#: template: as many may be added.
REACH = 2
#: What an added word between two matched parts takes from a match's words.
GAP_COST = 0.5
MIN_COVERAGE = 0.9

_TOKEN = re.compile(r"[^\W_]+(?:[.][0-9]+)*")
#: Numbers of list items: first on a line, or after the end of a clause.
_ITEM = re.compile(r"(?:^[^\w\n]*|[.:;,]\s+|\b(?:and|or)\s+)[(]?([0-9]{1,2})[.)](?=\s)", re.MULTILINE)


def plain_form(text: str) -> str:
    """What is compressed: the wording without case and line breaks."""
    return " ".join(text.lower().split())


def tokens(text: str) -> list[str]:
    return [t.lower() for t in _TOKEN.findall(text)]


def candidate_blocks(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """(start, end) of windows that hold every trigger word with ``reach``
    words to each side. Triggers less than ``reach`` words after the first of
    a window share it; the next window overlaps with it."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a letter whose lower case is longer
        lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    hits = sorted(m.start() for t in TRIGGERS for m in re.finditer(re.escape(t), lowered))
    if not hits:
        return
    starts = array("q", (m.start() for m in _TOKEN.finditer(text)))
    groups: list[list[int]] = []  # first and last word with a trigger
    for hit in hits:
        word = max(0, bisect_right(starts, hit) - 1)
        if groups and word - groups[-1][0] < reach:
            groups[-1][1] = word
        else:
            groups.append([word, word])
    for first, last in groups:
        lo, hi = max(0, first - reach), last + reach + 1
        yield starts[lo] if lo else 0, starts[hi] if hi < len(starts) else len(text)


def whole_words(text: str, start: int, end: int) -> tuple[int, int]:
    """The span up to the blanks around it."""
    while start and not text[start - 1].isspace():
        start -= 1
    while end < len(text) and not text[end].isspace():
        end += 1
    return start, end


class Scanner:
    """Compressors with each template as raw dictionary."""

    def __init__(self, templates: dict[str, str]):
        self.tokens = {name: tokens(t) for name, t in templates.items()}
        self.plain = zstandard.ZstdCompressor(level=3)
        self.sizes = {name: len(self.plain.compress(plain_form(t).encode())) for name, t in templates.items()}
        self.given = {
            name: zstandard.ZstdCompressor(
                level=3,
                dict_data=zstandard.ZstdCompressionDict(plain_form(t).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for name, t in templates.items()
        }

    def reductions(self, block: str, names: list[str]) -> Iterator[tuple[int, float]]:
        """(bytes that the template saves, the same as a share of the smaller
        of the compressed block and template) for each of ``names``."""
        data = plain_form(block).encode()
        alone = len(self.plain.compress(data))
        for name in names:
            saved = alone - len(self.given[name].compress(data))
            yield saved, saved / min(alone, self.sizes[name])

    def rank(self, block: str, names: list[str]) -> list[str]:
        """The templates by the bytes that they save, most first (ties by name)."""
        saved = {name: r[0] for name, r in zip(names, self.reductions(block, names), strict=True)}
        return sorted(names, key=lambda name: (-saved[name], name))

    def confirm(self, block: str, name: str) -> tuple[float, list[str], list[str], int, int] | None:
        """Share of the template's words in the block in order, the missing
        words, the words between, and the span in the block; None if a
        deciding word differs."""
        template = self.tokens[name]
        at = [m.span() for m in _TOKEN.finditer(block)]
        words = [block[i:j].lower() for i, j in at]
        matcher = SequenceMatcher(None, template, words, autojunk=False)
        matches = dense_part([m for m in matcher.get_matching_blocks() if m.size])
        if not matches:
            return None
        found = {i for m in matches for i in range(m.a, m.a + m.size)}
        missing = [w for i, w in enumerate(template) if i not in found]
        first, last = matches[0].b, matches[-1].b + matches[-1].size
        used = {j for m in matches for j in range(m.b, m.b + m.size)}
        items = {m.start(1) for m in _ITEM.finditer(block)}
        added = [j for j in range(first, last) if j not in used]
        deciding = [*missing, *(words[j] for j in added if at[j][0] not in items)]
        if any(w in DECIDING or w[0].isdigit() for w in deciding):
            return None
        coverage = len(found) / len(template)
        if coverage < MIN_COVERAGE:
            return None
        return coverage, missing, [words[j] for j in added], at[first][0], at[last - 1][1]

    def best(self, block: str) -> tuple | None:
        """(name, result) of the winner: the first of the ranked templates whose
        wording holds. A longer notice saves more than one that stands in it."""
        words = Counter(tokens(block))
        # The others cannot hold, in whatever order their words stand.
        able = [n for n, t in self.tokens.items() if (Counter(t) & words).total() >= MIN_COVERAGE * len(t)]
        for name in self.rank(block, able) if able else ():
            result = self.confirm(block, name)
            if result:
                return name, result
        return None

    def notices(self, text: str, start: int, end: int) -> Iterator[tuple]:
        """(start, end, name, coverage, missing, added) of a window: the winner,
        and those of what is left before and after it, until none holds."""
        parts = [(start, end)]
        while parts:
            start, end = parts.pop()
            best = self.best(text[start:end])
            if best:
                name, (coverage, missing, added, lo, hi) = best
                yield start + lo, start + hi, name, coverage, missing, added
                parts += [(start, start + lo), (start + hi, end)]

    def scan(self, text: str) -> Iterator[tuple]:
        """(start, end, license, reduction, coverage, missing, added) per
        notice, in order; the reduction is that of the notice. Of notices that
        overlap (windows do) the one whose template saves most of it counts."""
        reach = REACH * max(map(len, self.tokens.values()), default=0)
        found = {n for window in candidate_blocks(text, reach) for n in map(_hashable, self.notices(text, *window))}
        ranked = []
        for notice in found:
            start, end = whole_words(text, *notice[:2])
            ranked.append((*next(self.reductions(text[start:end], [notice[2]])), start, end, notice))
        taken: list[tuple] = []
        for _, share, start, end, notice in sorted(ranked, key=lambda r: (-r[0], r[4][:3])):
            at = bisect_right(taken, notice[:2], key=lambda t: t[0][:2])
            if at and taken[at - 1][0][1] > notice[0] or at < len(taken) and taken[at][0][0] < notice[1]:
                continue
            taken.insert(at, (notice, share, start, end))
        for (*_, name, coverage, missing, added), share, start, end in taken:
            yield start, end, name, share, coverage, " ".join(missing), " ".join(added)


def _hashable(notice: tuple) -> tuple:
    return tuple(tuple(v) if isinstance(v, list) else v for v in notice)


def dense_part(matches: list) -> list:
    """The run of matches with most words, less ``GAP_COST`` per word between:
    stray words far from the notice are not of it."""
    best, least, total, first, part = 0.0, 0.0, 0.0, 0, (0, 0)
    for i, m in enumerate(matches):
        if i:
            total -= GAP_COST * (m.b - matches[i - 1].b - matches[i - 1].size)
        if total <= least or not i:
            least, first = total, i
        total += m.size
        if total - least > best:
            best, part = total - least, (first, i + 1)
    return matches[slice(*part)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, start, end (characters of the notice), license, reduction,
    coverage, missing_words, added_words: one row per confirmed notice."""
    ship_package(docs.sparkSession)
    chosen = TEMPLATES if templates is None else dict(templates)
    kind = dict(docs.dtypes)["doc_id"]
    names = ["start", "end", "license", "reduction", "coverage", "missing_words", "added_words"]
    types = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1)):
                for row in scanner.scan(text.as_py() or ""):
                    at.append(i)
                    rows.append(row)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", *names],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, start int, end int, license string, reduction double, coverage double, missing_words string, added_words string",
    )
