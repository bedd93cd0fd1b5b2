"""Automaton tokenizer against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from tests.llm.conftest import ODD
from tributary.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Tokenizer(f.read())


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def texts():
    random.seed(5)
    yield from ["", " ", "\n\n  x", "VBLCCCCE", "a" * 300 + " " * 200, "x<|endoftext|><|endoftext|>y", "don't 'LL 's"]
    letters = [chr(c) for c in [*range(0x500), 0x2028, 0x3000, 0x1F600, 0x20000, 0xFFFD]]
    for _ in range(600):
        yield "".join(random.choice(letters) for _ in range(random.randrange(1, 40)))
    for _ in range(600):
        yield "".join(random.choice(["aa", "b", "the", "ing", "  ", " ", "\n", "1", "00", "!!", "=", "CC"]) for _ in range(random.randrange(1, 40)))


def test_same_ids_and_texts_as_the_library(own, library):
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_partial_characters_decode_like_the_library(own, library):
    for ids in ([160], [160, 247], [50256, 160, 11], [10263, 1]):
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_automaton_takes_the_leftmost_of_equal_pairs():
    vocab = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3, b"ab": 4}
    machine = bpe.MergeAutomaton(vocab, [(b"a", b"a"), (b"aa", b"b"), (b"a", b"b")])
    assert machine.encode_word(b"aaa") == [2, 0]
    assert machine.encode_word(b"aaab") == [2, 4]
    assert machine.encode_word(b"aab") == [3]
    assert not machine.arc(0, 0)
    assert machine.arc(2, 0)


def test_word_table_forgets_but_stays_right(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    words = bpe._Words(own.automaton)
    for _ in range(3):
        for word in ["alpha", " beta", " gamma", " delta", " epsilon"]:
            assert words[word][0] == ",".join(map(str, own.encode(word)))


def test_long_texts_are_hashed_in_blocks(own, monkeypatch):
    text = "some words, and <|endoftext|> more of them " * 40
    whole = own.digest(text)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 16)
    assert own.digest(text) == whole


def test_documents(frame, library):
    docs = frame(ODD)
    found = bpe.encode_documents(docs, PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for doc_id, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_ids_round_trip(frame):
    docs = frame(ODD)
    back = bpe.detokenize(bpe.token_ids(docs, PATH), PATH)
    assert sorted(map(str, back.collect())) == sorted(
        str(r) for r in docs.selectExpr("doc_id", "coalesce(text, '') as text").collect()
    )


def test_empty_table(frame):
    assert bpe.encode_documents(frame([]), PATH).collect() == []


def test_a_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in bpe.encode_documents(docs, PATH).collect()}
    rows = docs.select("doc_id", "text").collect()
    for row, own in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False), strict=True):
        ids = hashlib.sha256(",".join(map(str, own.ids)).encode()).hexdigest()
        decoded = library.decode(own.ids, skip_special_tokens=False)
        assert found[row.doc_id] == (len(own.ids), ids, hashlib.sha256(decoded.encode()).hexdigest())
