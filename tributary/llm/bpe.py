"""BPE encoding and decoding with a token automaton.

The merges of a byte-level BPE vocabulary are compiled into a deterministic
automaton over token labels, which accepts exactly the token sequences that
BPE produces. It starts as one state with a loop for each byte token. Each
merge (a, b) -> c, in rank order, adds one gadget: the state reached by ``a``
is copied without its arc ``b``, arcs ``a`` are redirected to the copy, and
every state with an arc ``a`` gets an arc ``c`` to the state that ``b`` reached.
All arcs with one label enter the same state, so the automaton is stored as the
label's target plus, for each gadget, the one arc that its copy lost; an arc
(x, y) is looked up along the copies that x's target was made from.

A pre-split word is encoded by running the automaton over it: from each state
the longest label that the word goes on with and that has an arc is taken, and
left again if the path ends before the word does. Decoding emits the arc
labels' bytes.

Edge cases: a null or empty text has no tokens and decodes to the empty text;
special-token strings in a text are their single ids, as the tokenizers
library does; one pre-split word may be as long as the text, and long texts
are hashed block by block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tributary.llm.common import blocks, ship_package, tidy

#: Fixed value: the pre-split pattern of byte-level BPE vocabularies.
PRE_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Words in each of the two halves of a worker's table of encoded words; when
#: the newer half is full it becomes the older one, which is dropped.
CACHE_WORDS = 100_000
#: Longer words are encoded each time.
CACHE_LETTERS = 48
BLOCK_WORDS = 1 << 16
#: Arcs kept in a worker's table of looked-up arcs.
CACHE_ARCS = 200_000
_NEVER = 1 << 60
ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write bytes as:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    """Labels, gadgets and arcs of the token automaton."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.label = {i: b for b, i in vocab.items()}
        self.lexicon: dict[bytes, int] = {}
        self._born: dict[int, int] = {}  # rank of the gadget that made the label's arcs
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._lost: dict[tuple[int, int], int] = {}  # (x, y): rank at which x's target lost arc y
        self._arcs: dict[tuple[int, int], bool] = {}
        for token, i in vocab.items():
            if len(token) == 1:
                self.lexicon[token] = i
                self._born[i] = -1
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if z in self._born:
                raise ValueError(f"two merges make token {z}")
            if x not in self._born or y not in self._born or not self._walk(x, y):
                continue  # no state has the two arcs in a row: the gadget adds none
            self._lost[x, y] = rank
            self._left[z], self._right[z], self._born[z] = x, y, rank
            self.lexicon[a + b] = z
        self.longest = max(map(len, self.lexicon), default=0)

    def _walk(self, x: int, y: int) -> bool:
        """Does the target of label x have an arc y?

        The target of x is a chain of copies: those made by x's own gadgets,
        then those that x's right part had when x's arcs were made. An arc y
        is absent if a copy lost it, or lost the arc it was derived from (y's
        left part) before y's arcs were made. A gadget (a, a) takes the arc
        from its copy first and derives the arcs aa after that, so there an
        equal rank counts as before.
        """
        before_x, i = _NEVER, x
        while i is not None:
            before_y, j = _NEVER, y
            while j is not None:
                rank = self._lost.get((i, j))
                if rank is not None and rank < before_x and rank <= before_y:
                    return False
                before_y, j = min(before_y, self._born[j]), self._left.get(j)
            before_x, i = min(before_x, self._born[i]), self._right.get(i)
        return True

    def arc(self, x: int, y: int) -> bool:
        found = self._arcs.get((x, y))
        if found is None:
            if len(self._arcs) >= CACHE_ARCS:
                self._arcs.clear()
            found = self._arcs[x, y] = self._walk(x, y)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The one path of the automaton whose labels spell the word.

        Longest labels are tried first. Every path to a position is the BPE
        sequence of that prefix, so there is one at most: a position that
        the path had to leave is never entered again.
        """
        get, arcs, longest = self.lexicon.get, self._arcs, self.longest
        whole = get(word)
        n = len(word)
        if whole is not None:
            return [whole]  # tokens in the lexicon are accepted alone
        path: list[int] = []
        starts, sizes, dead = [0], [min(longest, n)], set()
        state = -1  # label that led here; the start state has all arcs
        while True:
            at, size = starts[-1], sizes[-1]
            while size:
                token = get(word[at : at + size])
                if token is not None and at + size not in dead:
                    if state < 0:
                        break
                    arc = arcs.get((state, token))
                    if arc or arc is None and self.arc(state, token):
                        break
                size -= 1
            if size:
                path.append(token)
                at += size
                if at == n:
                    return path
                sizes[-1] = size - 1
                starts.append(at)
                sizes.append(min(longest, n - at))
                state = token
            else:
                dead.add(at)
                starts.pop()
                sizes.pop()
                if not path:
                    raise ValueError("a byte of the word is not in the vocabulary")
                path.pop()
                state = path[-1] if path else -1

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))


class _Words(dict):
    """word -> (ids as text, bytes of the arc labels), filled on demand."""

    def __init__(self, automaton: MergeAutomaton):
        super().__init__()
        self.automaton = automaton
        self.older: dict[str, tuple[str, bytes]] = {}

    def __missing__(self, word: str) -> tuple[str, bytes]:
        entry = self.older.get(word)
        if entry is None:
            ids = self.automaton.encode_word(word.encode())
            entry = ",".join(map(str, ids)), self.automaton.decode(ids)
        if len(word) <= CACHE_LETTERS:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = entry
        return entry


class Tokenizer:
    """A byte-level BPE vocabulary file (tokenizers JSON) as an automaton."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters, model = byte_letters(), data["model"]
        split = data["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or data["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-level BPE files are supported")
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in data["added_tokens"]):
            raise ValueError("added tokens must match as plain text")

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        self.automaton = MergeAutomaton(vocab, [(raw(a), raw(b)) for a, b in merges])
        self.added = added
        self.automaton.label.update({i: t.encode() for t, i in added.items()})
        self._special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._split = regex.compile(PRE_SPLIT)
        self.words = _Words(self.automaton)

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is an added token, text) parts of a text, in order."""
        if self._special is None:
            yield False, text
            return
        at = 0
        for m in self._special.finditer(text):
            if m.start() > at:
                yield False, text[at : m.start()]
            yield True, m.group()
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for special, part in self.pieces(text):
            if special:
                out.append(self.added[part])
            else:
                for word in self._split.findall(part):
                    out.extend(map(int, self.words[word][0].split(",")))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", errors="replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Token count, SHA-256 of the ids, SHA-256 of the decoded text."""
        ids, decoded, n = hashlib.sha256(), hashlib.sha256(), 0

        def entries(part: str) -> Iterator[list[tuple[str, bytes]]]:
            if len(part) <= BLOCK_WORDS:
                yield list(map(self.words.__getitem__, self._split.findall(part)))
            else:
                found = (self.words[m.group()] for m in self._split.finditer(part))
                yield from blocks(found, BLOCK_WORDS)

        parts = (
            iter([[(str(self.added[part]), part.encode())]]) if special else entries(part)
            for special, part in self.pieces(text or "")
        )
        # Pre-split words of a text are whole characters, so their bytes are
        # valid UTF-8 and need no replacement when they are decoded.
        for block in chain.from_iterable(parts):
            shown = ",".join([e[0] for e in block])
            ids.update((("," if n else "") + shown).encode())
            n += shown.count(",") + 1
            decoded.update(b"".join([e[1] for e in block]))
        return n, ids.hexdigest(), decoded.hexdigest()


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(spec: str) -> Tokenizer:
    """The compiled tokenizer of a worker, one per vocabulary."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = Tokenizer(spec)
    return _TOKENIZERS[name]


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as f:
        return ship_package(spark).sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode and decode every document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``vocabulary`` is the path of the vocabulary file on the driver; its text
    (a few MB, bounded by the file) is broadcast, so executors need no file.
    The work is one pass over the documents, without a shuffle.
    """
    spec = _vocabulary(docs.sparkSession, vocabulary)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = tokenizer(spec.value).digest
        for batch in batches:
            rows = [digest(text.as_py()) for text in batch.column(1)]
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=ENCODED.names,
            )

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, ENCODED)


def token_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids): the token ids themselves, for writing training shards."""
    spec = _vocabulary(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(spec.value).encode
        for batch in batches:
            ids = [encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def detokenize(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    spec = _vocabulary(encoded.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokenizer(spec.value).decode
        for batch in batches:
            texts = [None if ids.as_py() is None else decode(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
