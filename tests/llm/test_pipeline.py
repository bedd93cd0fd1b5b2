"""The pipeline against a brute-force version, and the registered queries."""

import hashlib
import inspect
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_mixing, test_near_duplicates
from tests.llm.test_quality import english
from tributary.llm import graph, mixing, near_duplicates, quality, suffixes
from tributary.llm.common import WORD_RE

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def corpus():
    r = random.Random(11)
    rows = []
    shared = english(60, 777)
    for i in range(90):
        text = english(r.randrange(40, 160), i)
        if i % 5 == 0:
            text = f"{text[:200]}\n{shared}\n{text[200:]}"
        rows.append([i, text, "en", f"s{i % 4}" if i % 9 else None])
    rows += [[200, rows[3][1], "en", "s0"], [201, rows[4][1] + " tail", "en", "s1"], [202, "%%% ### " * 50, "en", "s1"], [203, None, None, None], [204, "", "en", "s2"]]
    return rows


def cut(rows):
    """Texts without the bytes of 100-byte strings that also start earlier."""
    seen, out = set(), []
    for r in sorted(rows):
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        text = bytes(b for b, g in zip(data, gone, strict=True) if not g).decode("utf-8", errors="ignore")
        out.append([r[0], text, *r[2:]])
    return out


def test_pipeline_like_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], COLUMNS)
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    references = quality.language_references(docs)
    kept = [r for r in rows if quality.judge(r[1], references)[-1]]
    assert {r[0] for r in rows} - {r[0] for r in kept} >= {202, 203, 204}
    classes = {d: c for d, c, _ in test_near_duplicates.brute([(r[0], r[1]) for r in kept])}
    kept = [r for r in kept if classes[r[0]] == r[0]]
    assert not {200, 201} & {r[0] for r in kept}
    kept = cut(kept)
    assert sum(len(r[1]) for r in kept) < sum(len(r[1]) for r in rows if r[0] in {x[0] for x in kept})
    taken = test_mixing.brute([(r[0], r[1], r[2], r[3]) for r in kept])[2]
    library, want = Library.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for doc_id, text, _, source in kept:
        size = len(WORD_RE.findall(text))
        ids = library.encode(text, add_special_tokens=False).ids
        row = (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        if size and taken[doc_id, source, size]:
            want[row] += taken[doc_id, source, size] // size
    assert got == want


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in corpus()], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, str(tmp_path))
        assert docs_after.dtypes == docs.dtypes


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES) - 1))
def test_no_name_of_a_column_clashes(spark, tmp_path, stage):
    """Every name in the operators' code, as further columns."""
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in corpus()[:60]], COLUMNS).coalesce(2)
    code = "".join(inspect.getsource(m) for m in (quality, near_duplicates, suffixes, mixing, graph))
    names = {n.lower() for n in re.findall(r'"([A-Za-z_]\w*)"', code)}
    names |= {"_d", "_cut", "_node", "_kept_id", "_own_reference", "_own_reference_lang"}
    more = docs.select("*", *[F.lit("clash").alias(n) for n in sorted(names - set(docs.columns))])
    run = corpus_pipeline.STAGES[stage][1]
    plain, found = run(spark, docs, str(tmp_path)), run(spark, more, str(tmp_path))
    assert found.columns == more.columns
    assert sorted(map(tuple, found.select(*docs.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert mixing.SHARE == 1.5


def test_no_local_checkpoint_in_the_package():
    import pathlib

    for path in pathlib.Path(corpus_pipeline.__file__).parent.glob("tributary/**/*.py"):
        assert "localCheckpoint(" not in path.read_text()
