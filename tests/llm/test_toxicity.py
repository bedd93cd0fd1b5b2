import random
import zlib

import pytest

from tests.llm.conftest import ODD
from tributary.llm import toxicity

INSULTS = ["zorkel", "blimph", "gruntan", "gruntoz", "gruntiks"]


def corpus(n=900, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choices("aeioulmnprst", k=5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(20, 120))]
        toxic = int(i % 6 == 0)
        for _ in range(2 * toxic):
            text.insert(r.randrange(len(text)), r.choice(INSULTS))
        for at in range(0, len(text), 9):
            text[at] += "."
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture()
def tables(frame, spark):
    rows, labels = corpus()
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    return frame([*rows, *((None if r[0] is None else r[0] + 10_000, *r[1:]) for r in ODD)]), table


def test_held_out_documents(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id is not None and r.toxic is not None}
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    for r in found:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_training_leaves_out_the_held_fold(tables, spark):
    docs, labels = tables
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.fold(toxicity.F.col("doc_id")) == 0, 1 - labels.toxic).otherwise(labels.toxic))
    one = {(r.doc_id, r.score) for r in toxicity.toxicity(docs, labels).collect()}
    assert one == {(r.doc_id, r.score) for r in toxicity.toxicity(docs, flipped).collect()}


def test_copies_of_a_toxic_text_teach_no_words(frame, spark):
    rows, labels = corpus(600)
    copy = "quarnel vexpod tilmar wobnix zorkel " * 3
    rows += [(5000 + i, copy) for i in range(60)]
    labels += [(5000 + i, 1) for i in range(60)]
    model = toxicity.fit(frame(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "zorkel" in model.lexicon.words
    assert not {"quarnel", "vexpod", "tilmar", "wobnix"} & set(model.lexicon.words)
    assert any("gruntan".startswith(s) for s in model.lexicon.stems)


def model():
    return toxicity.Model({"moron": 4.0}, {"grunt": 3.0}, [-3.0, 1.0, 0.5, 0.5])


def test_the_grammar_weighs_contexts():
    m = model()
    plain, targeted = m.clauses("a moron here"), m.clauses("you are a moron")
    negated, reported = m.clauses("they are not a moron"), m.clauses("she said moron today")
    assert plain == [4.0] and targeted == [6.0]
    assert negated == [pytest.approx(1.2)] and reported[0] == pytest.approx(3.0)
    assert m.clauses("i will hurt you") == [pytest.approx(4.0 * 0.3)]
    assert m.clauses("we kill time") == [pytest.approx(4.0 * 0.3)]
    assert m.clauses("you all i will kill") == [pytest.approx(4.0 * 1.2)]
    assert m.clauses("you and all of us will kill") == [pytest.approx(4.0 * 0.3)]
    assert m.clauses("gruntings") == [3.0]
    assert m.clauses("not now. moron! ok\nmoron moron") == [4.0, 8.0]
    assert m.clauses("nothing of the kind") == []


def test_composition_equals_running_in_sequence():
    r = random.Random(3)
    whole, parts = toxicity.grammar(), [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.scorer()]
    for _ in range(300):
        symbols = r.choices(["I", "T", "G", "N", "R", "O"], k=r.randrange(1, 15))
        state, states, one, other = whole.start, [p.start for p in parts], [], []
        for s in symbols:
            _, w, state = whole.step(state, s)
            one.append(w)
            total = 1.0
            for i, p in enumerate(parts):
                s, w, states[i] = p.step(states[i], s)
                total *= w
            other.append(total)
        assert one == pytest.approx(other)


def test_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(frame(ODD), none).collect()
    assert len(found) == len(ODD) and all(0 <= r.score < 0.5 for r in found)
    assert toxicity.toxicity(frame([]), none).collect() == []


def test_a_repeated_doc_id_gives_one_training_row(frame, spark):
    rows, labels = corpus(60)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    once = sorted(tuple(r) for r in toxicity.training_rows(frame(rows), table).collect())
    again = sorted(tuple(r) for r in toxicity.training_rows(frame(rows + rows[:10] * 5), table).collect())
    assert again == once and len(once) <= 60
