import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tributary.llm import quality
from tributary.llm.common import WORD_RE


def brute_base(text):
    words = WORD_RE.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    marked = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD_RE.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked), failed


def english(n, seed):
    r = random.Random(seed)
    common = "the of and to in a is that it was for on with as be by at this".split()
    return " ".join(r.choice(common) if r.random() < 0.5 else "".join(r.choices("etaoinshr", k=6)) for _ in range(n))


def test_base_figures_like_brute_force(frame):
    r = random.Random(2)
    rows = [*ODD]
    for i in range(60):
        words = [r.choice("ab cd ef gh #x |".split()) for _ in range(r.randrange(0, 90))]
        rows.append((100 + i, "".join(w + r.choice([" ", " ", "\n", "\t"]) for w in words), "en"))
    rows.append((900, "one two three four five six seven eight nine " * 5, "en"))
    got = quality.quality(frame(rows)).collect()
    want = sorted((str(i), brute_base(t)) for i, t, *_ in rows)
    have = sorted((str(g.doc_id), (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed)) for g in got)
    assert have == want
    assert all(not g.kept for g in got if g.base_failed)


def test_far_documents_go_and_clean_ones_stay(frame):
    rows = [(i, english(120, i), "en") for i in range(60)]
    rows.append((1000, " ".join(f"{w}%%%" for w in english(150, 99).split()), "en"))
    rows.append((1001, " | ".join("".join(random.Random(i).choices("xqzvkj", k=9)) for i in range(150)), "en"))
    rows.append((1002, "0123 4567 8901 " + " ".join(str(i * 7919) for i in range(200)), None))
    kept = {r.doc_id: r.kept for r in quality.quality(frame(rows)).collect()}
    assert all(kept[i] for i in range(60))
    assert not kept[1000] and not kept[1001] and not kept[1002]


def test_short_texts_are_not_compared(frame):
    rows = [(i, english(120, i), "en") for i in range(30)] + [(500, "#### " * 25, "en")]
    found = {r.doc_id: r for r in quality.quality(frame(rows)).collect()}
    assert found[500].char_distance is None and found[500].word_distance is None


def test_distance_is_the_jensen_shannon_distance():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert quality.js_distance(p, q) == pytest.approx(1.0)
    assert quality.js_distance(p, p) == 0.0
    p, q = np.array([3.0, 1.0, 0.0]), np.array([1.0, 1.0, 2.0])
    m = (p / 4 + q / 4) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
    assert quality.js_distance(p, q) == pytest.approx(((kl(p / 4) + kl(q / 4)) / 2) ** 0.5)


def test_references_count_every_document(frame):
    rows = [(i, "Alpha beta, beta. " * 3, "en") for i in range(10)] + [(20, "gamma", "de"), (21, "x", None), (22, None, "en")]
    references = quality.language_references(frame(rows))
    assert references.bins["en"] == {"beta": 0, "alpha": 1}
    assert references.words["en"].tolist() == [60.0, 30.0, 0.0]
    assert set(references.chars) == {"en", "de"}


def test_kept_documents_keep_their_columns(frame):
    docs = frame([(i, english(100, i), "en") for i in range(20)] + ODD)
    kept = quality.kept_documents(docs)
    assert kept.schema == docs.schema
    want = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_without_references_the_base_rules_hold(frame):
    rows = [(1, english(50, 1), None), (2, "short", None)]
    assert {r.doc_id: r.kept for r in quality.quality(frame(rows)).collect()} == {1: True, 2: False}
    assert quality.quality(frame([])).collect() == []


def test_copies_do_not_shift_the_reference(frame):
    rows = [(i, english(60, i), "en") for i in range(60)]
    copy = " ".join("".join(random.Random(i).choices("etaoinshr", k=5)) for i in range(60))
    rows += [(1000 + i, copy, "en") for i in range(60)]
    kept = {r.doc_id: r.kept for r in quality.quality(frame(rows)).collect()}
    alone = {r.doc_id: r.kept for r in quality.quality(frame(rows[:61])).collect()}
    assert [i for i in range(60) if kept[i] != alone[i]] == []
    one, many = (quality.language_references(frame(r)).words["en"] for r in (rows[:61], rows))
    assert one / one.sum() == pytest.approx(many / many.sum())


def drawn(cover, n, seed):
    """A text of n words of which a share of ``cover`` is common."""
    r = random.Random(seed)
    common, weights = [f"c{i}" for i in range(64)], [1 / (i + 3) for i in range(64)]
    return [r.choices(common, weights)[0] if r.random() < cover else f"x{r.random()}" for _ in range(n)]


def of_cover(covers):
    shares = {lang: {f"c{i}": 1e6 * c / (i + 3) / sum(1 / (j + 3) for j in range(64)) for i in range(64)} for lang, c in covers.items()}
    return quality.References({}, shares, dict.fromkeys(covers, 10**6))


@pytest.mark.parametrize("cover", [0.3, 0.37, 0.45, 0.55, 0.7])
@pytest.mark.parametrize("n", [40, 60, 100, 1000])
def test_clean_texts_stay_and_texts_without_common_words_go_at_any_cover(cover, n):
    references = of_cover({"en": cover})
    clean = [quality.judge(" ".join(drawn(cover, n, seed)), references)[-1] for seed in range(100)]
    assert sum(clean) >= 99
    assert not quality.judge(" ".join(drawn(0.0, n, 1)), references)[-1]


def test_a_reference_of_low_cover_judges_no_words_and_excuses_no_other_language():
    references = of_cover({"en": 0.5, "zh": 0.05})
    junk = " ".join(drawn(0.0, 200, 3))
    assert not quality.judge(junk, references, "en")[-1]
    assert quality.judge(junk, references, "zh")[-2:] == (None, True)


def test_languages_beyond_the_largest_have_references_of_their_own(frame):
    rows = []
    for k in range(quality.MAX_LANGUAGES + 4):
        common = ["".join(random.Random(1000 * k + i).choices("aeioulnrst", k=4)) + str(k) for i in range(30)]
        for i in range(4 if k < quality.MAX_LANGUAGES else 3):
            r = random.Random(100 * k + i)
            rows.append((100 * k + i, " ".join(r.choice(common) for _ in range(80)), f"l{k}"))
    last = f"l{quality.MAX_LANGUAGES + 3}"
    rows.append((99_999, " ".join("".join(random.Random(i).choices("aeioulnrst", k=5)) for i in range(80)), last))
    docs = frame(rows)
    kept = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    assert len(kept) == len(rows)
    assert [i for i, k in kept.items() if not k] == [99_999]
    left = quality.kept_documents(docs)
    assert left.schema == docs.schema
    assert {r.doc_id for r in left.collect()} == {i for i, k in kept.items() if k}
