import random

from tests.llm.conftest import ODD
from tributary.llm import licenses


def filler(n, seed=0):
    return " ".join("".join(random.Random(seed + i).choices("abcdefgh", k=5)) for i in range(n))


def found(frame, rows, **kw):
    return {(r.doc_id, r.license) for r in licenses.scan_licenses(frame(rows), **kw).collect()}


def test_every_template_is_found_in_a_text(frame):
    rows, want = [], set()
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        rows.append((i, f"{filler(60, i)}\n{text}\n{filler(60, i + 500)}"))
        want.add((i, name))
        rows.append((100 + i, f"{filler(300, i)} {text} {filler(300, i + 500)}"))
        want.add((100 + i, name))
    assert found(frame, rows) == want


def test_versions_and_variants_are_told_apart(frame):
    rows = [
        (1, "Licensed under the Apache License, Version 1.1."),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "licensed under cc by-nc-sa 4.0"),
        (4, "LICENSED UNDER  THE\nAPACHE LICENSE, VERSION 2.0"),
        (5, "The fishing license was renewed with the permission of the harbour master."),
        (6, "Released under the MIT license"),
    ]
    assert found(frame, rows) == {(2, "GPL-2.0"), (4, "Apache-2.0"), (6, "MIT")}


def test_wording_differences_are_reported(frame):
    text = licenses.TEMPLATES["MIT text"].replace("to any person", "to every nice person").replace("without limitation ", "")
    row = licenses.scan_licenses(frame([(1, "x\n" + text)])).collect()[0]
    assert (row.license, row.missing_words, row.added_words) == ("MIT text", "any without limitation", "every nice")
    assert 0.9 <= row.coverage < 1 and row.reduction > 0.3
    assert ("x\n" + text)[row.start : row.end] == text


def test_several_blocks_of_a_document(frame):
    text = f"Released under the MIT License.\n{filler(50)}\n\n\n\n\nLicensed under CC BY-NC 4.0."
    assert found(frame, [(1, text)]) == {(1, "MIT"), (1, "CC-BY-NC-4.0")}


def test_own_templates(frame):
    own = {"house": "All rights under the house licence number 7 remain with the author."}
    assert found(frame, [(1, own["house"]), (2, own["house"].replace("7", "8"))], templates=own) == {(1, "house")}


def test_odd_rows(frame):
    assert found(frame, ODD) == set()
    assert found(frame, []) == set()
    assert found(frame, [(1, "İ" * 50 + " Released under the MIT License.")] * 2) == {(1, "MIT")}
    long = filler(60_000) + "\nReleased under the MIT License."
    assert found(frame, [(None, long)]) == {(None, "MIT")}


MIT_FILE = """MIT License

Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD_FILE = """Copyright 2020 A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
APACHE_FILE = """   Copyright 2020 A. Author

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""


def test_published_files_are_found_as_wrapped(frame):
    late = f"{filler(10)} license {filler(150)} {licenses.TEMPLATES['MIT text']} {filler(100)}"
    rows = [(1, MIT_FILE), (2, BSD_FILE), (3, APACHE_FILE), (4, late)]
    rows += [(5, BSD_FILE.replace("modification,", "modification 3 times,"))]
    assert found(frame, rows) == {(1, "MIT text"), (2, "BSD text"), (3, "Apache-2.0 header"), (4, "MIT text")}


def test_every_license_of_a_document_is_found(frame):
    both = "Released under the MIT License. Licensed under CC BY 4.0."
    names = ["MIT", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0"]
    rows = [
        (1, both),
        (2, both.replace(". L", ".\nL")),
        (3, f"{filler(300)} {both} {filler(300, 900)}"),
        (4, "\n".join(licenses.TEMPLATES[n] for n in names)),
        (5, MIT_FILE + "\n" + APACHE_FILE + "\n" + BSD_FILE),
        (6, "Released under the MIT License.\n" * 3),
    ]
    want = {(i, n) for i in (1, 2, 3) for n in ("MIT", "CC-BY-4.0")} | {(4, n) for n in names}
    want |= {(5, n) for n in ("MIT text", "Apache-2.0 header", "BSD text")} | {(6, "MIT")}
    assert found(frame, rows) == want
    got = licenses.scan_licenses(frame(rows)).collect()
    assert len(got) == len(want) + 2
    texts = dict(rows)
    assert {texts[6][r.start : r.end] for r in got if r.doc_id == 6} == {"Released under the MIT License."}


VARIANTS = {
    # In the order of the names the wrong one would come first: both hold.
    "house 1": "All rights under the house licence remain with the author and nobody may sell copies of this work abroad.",
    "house 2": "All rights under the house licence remain with the author and anybody may sell copies of this work abroad.",
}


def test_the_ranking_alone_decides_between_templates_that_hold(monkeypatch):
    block = f"{filler(40)} {VARIANTS['house 2']} {filler(40, 70)}"
    scanner = licenses.Scanner(VARIANTS)
    assert all(scanner.confirm(block, name) for name in VARIANTS)
    assert scanner.rank(block, list(VARIANTS)) == ["house 2", "house 1"]
    assert [n[2] for n in scanner.scan(block)] == ["house 2"]
    monkeypatch.setattr(licenses.Scanner, "reductions", lambda self, block, names: ((0, 0.0) for _ in names))
    assert [n[2] for n in scanner.scan(block)] == ["house 1"]


def every_window(text):
    """(start word, license) of the templates that stand word for word in the
    text, tried at every word, without those inside another one."""
    words = licenses.tokens(text)
    spans = []
    for name, template in licenses.TEMPLATES.items():
        own = licenses.tokens(template)
        spans += [(i, i + len(own), name) for i in range(len(words)) if words[i : i + len(own)] == own]
    return sorted(
        (i, name) for i, j, name in spans
        if not any(a <= i and j <= b and (a, b) != (i, j) for a, b, _ in spans)
    )


def test_like_all_templates_at_all_windows(frame):
    r = random.Random(5)
    names = list(licenses.TEMPLATES)
    rows = []
    for i in range(60):
        parts = [filler(r.choice([0, 1, 5, 40, 300]), r.randrange(10**6))]
        for _ in range(r.randrange(4)):
            parts += [licenses.TEMPLATES[r.choice(names)], filler(r.choice([3, 20, 250]), r.randrange(10**6))]
        rows.append((i, r.choice([" ", "\n"]).join(parts)))
    want = sorted((i, name) for i, text in rows for _, name in every_window(text))
    texts = dict(rows)
    got = licenses.scan_licenses(frame(rows)).collect()
    assert sorted((x.doc_id, x.license) for x in got) == want
    for x in got:
        assert licenses.tokens(texts[x.doc_id][x.start : x.end]) == licenses.tokens(licenses.TEMPLATES[x.license])
        assert x.coverage == 1 and not x.missing_words and not x.added_words
