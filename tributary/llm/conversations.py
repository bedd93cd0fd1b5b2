"""Repair of damaged conversations by alignment with an alternating grammar.

The roles of a repaired conversation spell ``(s?(ua)+)?`` by their initials. The
cheapest edits are found by Wagner-Fischer alignment of the turns with each
feasible length of the alternating string; of the cheapest ones the audit (the
initials of the edits in order) that is least in ASCII is kept.

1. Turns are sorted by (conversation, turn, role, digest of the text) over
   range partitions, so a conversation of any length is spread over tasks, and
   cut into blocks of at most ``BLOCK`` turns; the blocks are staged.
2. A turn whose role and text stood earlier in its conversation is found by the
   first place of each (conversation, role, digest), a combined aggregate.
3. In a block, the turns are aligned with each feasible length of the string
   that can follow a phase (nothing yet, after s, after u, after a), for every
   phase the block can be entered in. Cells outside Ukkonen's band (the
   diagonals that the incumbent's cost can still pay for) are left out, lengths
   that it can't pay for too; the audits are traced back and compared.
4. The blocks of a conversation are chained phase by phase. Only their marks (two
   characters a turn) travel for that; an edit list goes back to each block,
   where the repaired turns are written.

Chaining keeps the least audit: two audits of the same turns, each ending with a
turn's edit (inserts stand before a turn, or at the end of the conversation),
are never one the beginning of the other, so their order holds whatever follows.

Edge cases: a null role or text counts as one blank; turns that tie on (turn,
role) are ordered by their text's MD5, null turns first; a null conv_id is a
conversation of its own; roles with other initials can only be given a new role
or be deleted; repeated rows are duplicates; a conversation of which nothing is
left after the damage has an empty audit; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tributary.llm.common import shuffle_partitions, ship_package, stage_table, tidy

BLOCK = 16
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
#: Phases of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
_LEGAL = ("su", "ua", "au")
_PHASE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


# --- damage ------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of
    ``conv_id:turn`` modulo 20 says: 0 drops a row, 1 empties its text, 2 removes
    its ends of sentences, 3 repeats it, 4 makes it the user's."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where(F.col("kind") != 0)
        .select(
            "conv_id", "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


# --- alignment ----------------------------------------------------------------------------

#: A turn as the alignment sees it: its initial, and '-' (fine), 't' (cut off)
#: or 'x' (blank or a duplicate, which must go).
Turn = tuple[str, str]


def alternating(phase: int, length: int) -> str:
    """The string of that length that follows a phase (without s)."""
    return ("au" if phase == USER else "ua") * (length // 2) + ("a" if phase == USER else "u") * (length % 2)


def align(turns: tuple[Turn, ...], target: str, limit: int) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that turn ``turns`` into ``target``,
    the least audit of those; None if they cost more than ``limit``. The last
    edit is a turn's."""
    n, m = len(turns), len(target)

    def least(diagonal: int) -> int:
        """What a path through the diagonal pays for inserts and deletions."""
        rest = m - n - diagonal
        return INSERT * (max(diagonal, 0) + max(rest, 0)) + DELETE * (max(-diagonal, 0) + max(-rest, 0))

    band = [d for d in range(-n, m + 1) if least(d) <= limit]
    if not band:
        return None
    low, high = band[0], band[-1]
    far = limit + 1
    # cost[i][j]: of aligning the turns from i with the target from j.
    cost = [[far] * (m + 2) for _ in range(n + 2)]
    cost[n][m] = 0
    for i in range(n - 1, -1, -1):
        initial, mark = turns[i]
        extra = CUT_OFF if mark == "t" else 0
        own, below = cost[i], cost[i + 1]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = below[j] + DELETE
            if j < m:
                wanted = target[j]
                if wanted != "s":
                    best = min(best, own[j + 1] + INSERT)
                if mark != "x":
                    if initial == wanted:
                        best = min(best, below[j + 1] + extra)
                    if wanted != "s":
                        best = min(best, below[j + 1] + extra + REROLE)
            own[j] = min(best, far)
    if cost[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        initial, mark = turns[i]
        extra = CUT_OFF if mark == "t" else 0
        now = cost[i][j]
        if now == cost[i + 1][j] + DELETE:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and now == cost[i][j + 1] + INSERT:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if initial == target[j] and now == cost[i + 1][j + 1] + extra else "R")
            i += 1
            j += 1
    return cost[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def edits(phase: int, turns: tuple[Turn, ...]) -> dict[int, tuple[int, str]]:
    """For each phase that a block can be left in, entered in ``phase``: cost
    and least audit over all feasible lengths."""
    found: dict[int, tuple[int, str]] = {}
    n = len(turns)
    staying = sum(mark != "x" for _, mark in turns)
    # From the likeliest length outwards. No turn needs two inserts before it.
    for length in sorted(range(2 * n + 1), key=lambda m: abs(m - staying)):
        heads = ["", "s"] if phase == START and length else [""]
        for head in heads:
            target = head + alternating(phase, length - len(head))
            leaving = _PHASE[target[-1]] if target else phase
            incumbent = found.get(leaving)
            limit = incumbent[0] if incumbent else DELETE * n + INSERT * length
            if INSERT * (length - n) > limit or DELETE * (n - length) > limit:
                continue
            one = align(turns, target, limit)
            if one and (incumbent is None or one < incumbent):
                found[leaving] = one
    return found


class Chain:
    """The blocks of one conversation so far: for each phase the cheapest
    cost, the rank of its audit among the phases' audits, and the way there."""

    def __init__(self) -> None:
        self.state: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.back: list[dict[int, tuple[int, str]]] = []

    def add(self, turns: tuple[Turn, ...]) -> None:
        best: dict[int, tuple[int, int, str, int]] = {}
        for phase, (cost, rank) in self.state.items():
            for leaving, (more, piece) in edits(phase, turns).items():
                one = (cost + more, rank, piece, phase)
                if leaving not in best or one < best[leaving]:
                    best[leaving] = one
        audits = sorted((rank, piece, leaving) for leaving, (_, rank, piece, _) in best.items())
        places = {leaving: i for i, (_, _, leaving) in enumerate(audits)}
        self.state = {leaving: (one[0], places[leaving]) for leaving, one in best.items()}
        self.back.append({leaving: (one[3], one[2]) for leaving, one in best.items()})

    def finish(self) -> tuple[int, list[tuple[int, str]]]:
        """(cost, (phase entered, audit) of each block)."""
        inserts = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
        cost, _, phase = min((c + INSERT * inserts[p], rank, p) for p, (c, rank) in self.state.items())
        pieces, tail = [], "I" * inserts[phase]
        for step in reversed(self.back):
            phase, piece = step[phase]
            pieces.append((phase, piece + tail))
            tail = ""
        return cost, pieces[::-1]


def repaired(turns: list[tuple[str, str]], phase: int, audit: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that a block's audit leaves."""
    out, rows = [], iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES[alternating(phase, 1)]
        out.append((edit, role, text))
        phase = _PHASE[role[0]]
    return out


# --- the jobs -----------------------------------------------------------------------------

_TURNS = "turns array<struct<role: string, text: string, digest: string>>"


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def blocks(rows: DataFrame) -> DataFrame:
    """Staged blocks of the sorted turns: conv_id, block (rising along a
    conversation), marks (initial and state of each turn), first and last turn
    number, how many there are, and the turns."""
    kind = rows.schema["conv_id"].dataType
    role, text = (F.coalesce(name, F.lit(" ")) for name in ("role", "text"))
    keyed = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.md5(text).alias("digest"),
        F.monotonically_increasing_id().alias("salt"),  # equal rows can go to several partitions
    )
    order = ["conv_id", "turn", "role", "digest", "salt"]
    dealt = keyed.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 36
        out: list[dict] = []
        held: list[tuple] = []

        def close() -> None:
            nonlocal at
            numbers = [r[1] for r in held if r[1] is not None]
            out.append(
                {
                    "conv_id": held[0][0], "block": at, "marks": "".join(mark(r[2], r[3]) for r in held),
                    "first_turn": numbers[0] if numbers else None, "last_turn": numbers[-1] if numbers else None,
                    "n_turns": len(set(numbers)),
                    "turns": [{"role": r[2], "text": r[3], "digest": r[4]} for r in held],
                }
            )
            at += 1
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                if held and (len(held) == BLOCK or held[0][0] != row[0]):
                    close()
                held.append(row)
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if held:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    schema = f"conv_id {kind.simpleString()}, block long, marks string, first_turn long, last_turn long, n_turns long, {_TURNS}"
    arrow = arrow_schema(schema)
    return stage_table(dealt.mapInArrow(cut, schema), "conversation-blocks")


def mark(role: str, text: str) -> str:
    last = _last_sign(text)
    return (role[:1] if role[:1] in _PHASE else "?") + ("x" if last is None else "-" if last in ".!?" else "t")


def _last_sign(text: str) -> str | None:
    """The last character that isn't ASCII white space."""
    text = text.rstrip(" \t\n\x0b\x0c\r")
    return text[-1] if text else None


def first_places(staged: DataFrame) -> DataFrame:
    """(block, firsts): which turns of a block are the first of their
    conversation with their role and text, as bits."""
    turns = staged.select("conv_id", "block", F.posexplode("turns").alias("i", "t"))
    place = F.col("block") * BLOCK + F.col("i")
    first = turns.groupBy("conv_id", F.col("t.role").alias("role"), F.col("t.digest").alias("digest")).agg(F.min(place).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1), F.pmod("place", F.lit(BLOCK)).cast("int"))
    return first.groupBy(F.shiftright("place", BLOCK.bit_length() - 1).alias("block")).agg(F.bit_or(bit).alias("firsts"))


_EDITS = (
    "conv_id {type}, block long, phase int, audit string, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long"
)


def chained(staged: DataFrame) -> DataFrame:
    """Staged edits: a row per block (block, phase, audit), and one per
    conversation (block null) with its counts, cost and whole audit."""
    marks = staged.select("conv_id", "block", "marks", "first_turn", "last_turn", "n_turns").join(
        first_places(staged), "block", "left"
    )
    columns = ["conv_id", "block", "marks", "firsts", "first_turn", "last_turn", "n_turns"]
    dealt = marks.select(*columns).repartition(shuffle_partitions(staged.sparkSession), "conv_id").sortWithinPartitions("conv_id", "block")
    schema = _EDITS.format(type=staged.schema["conv_id"].dataType.simpleString())
    arrow = arrow_schema(schema)

    @tidy
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        own: Conversation | None = None
        for batch in batches:
            for conv_id, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        out.extend(own.rows())
                    own = Conversation(conv_id)
                own.add(*rest)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if own is not None:
            out.extend(own.rows())
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stage_table(dealt.mapInArrow(chain, schema), "conversation-edits")


class Conversation:
    """Counts and chain of a conversation whose blocks come in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.chain = Chain()
        self.blocks: list[int] = []
        self.counts = {"x": 0, "d": 0, "t": 0}
        self.illegal = self.distinct = 0
        self.first = self.last = None
        self.initial = ""

    def add(self, block: int, marks: str, firsts: int | None, first: int | None, last: int | None, n_turns: int) -> None:
        turns = []
        for i in range(0, len(marks), 2):
            initial, state = marks[i], marks[i + 1]
            self.illegal += bool(self.initial) and self.initial + initial not in _LEGAL
            self.initial = initial
            fault = state if state == "x" or (firsts or 0) >> (i // 2) & 1 else "d"
            if fault != "-":
                self.counts[fault] += 1
            turns.append((initial, "x" if fault == "d" else state))
        self.distinct += n_turns - (first is not None and first == self.last)
        if first is not None:
            self.first = first if self.first is None else self.first
            self.last = last
        self.chain.add(tuple(turns))
        self.blocks.append(block)

    def rows(self) -> Iterator[dict]:
        cost, pieces = self.chain.finish()
        for block, (phase, audit) in zip(self.blocks, pieces, strict=True):
            yield {"conv_id": self.conv_id, "block": block, "phase": phase, "audit": audit}
        yield {
            "conv_id": self.conv_id, "audit": "".join(audit for _, audit in pieces),
            "gaps": 0 if self.first is None else self.last - self.first + 1 - self.distinct,
            "blank": self.counts["x"], "duplicate": self.counts["d"], "truncated": self.counts["t"],
            "illegal": self.illegal, "cost": cost,
        }


def repaired_blocks(staged: DataFrame, edits_of: DataFrame) -> DataFrame:
    """(conv_id, block, turns): the repaired turns of each block, in order."""
    schema = f"conv_id {staged.schema['conv_id'].dataType.simpleString()}, block long, turns array<struct<edit: string, role: string, text: string>>"
    arrow = arrow_schema(schema)

    @tidy
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv_id, block, turns, phase, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left = repaired([(t["role"], t["text"]) for t in turns], phase, audit)
                out.append({"conv_id": conv_id, "block": block, "turns": [dict(zip(("edit", "role", "text"), t, strict=True)) for t in left]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    pieces = edits_of.where(F.col("block").isNotNull()).select("block", "phase", "audit")
    return (
        staged.select("conv_id", "block", "turns").join(pieces, "block").select("conv_id", "block", "turns", "phase", "audit").mapInArrow(apply, schema)
    )


def digests(whole: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired blocks. One hash over a
    conversation's text runs through it in order: its blocks stream through one
    task, which holds one of them at a time."""
    schema = f"conv_id {whole.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    arrow = arrow_schema(schema)

    @tidy
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        now, running, any_turn = None, None, False
        for batch in batches:
            for conv_id, _, turns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if running is None or conv_id != now:
                    if running is not None:
                        out.append({"conv_id": now, "repaired_sha256": running.hexdigest()})
                    now, running, any_turn = conv_id, hashlib.sha256(), False
                for t in turns:
                    running.update((("\n" if any_turn else "") + f"{t['role']}:{t['text']}").encode())
                    any_turn = True
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if running is not None:
            out.append({"conv_id": now, "repaired_sha256": running.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    dealt = whole.repartition(shuffle_partitions(whole.sparkSession), "conv_id").sortWithinPartitions("conv_id", "block")
    return dealt.mapInArrow(stream, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row per conversation with counts, cost and audit; the repaired
    blocks) of turns (conv_id, turn, role, text)."""
    ship_package(rows.sparkSession)
    staged = blocks(rows)
    found = chained(staged)
    report = found.where(F.col("block").isNull()).drop("block", "phase")
    return report, repaired_blocks(staged, found)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, block, place (in the block), edit, role, text."""
    _, whole = repair(rows)
    return whole.select("conv_id", "block", F.posexplode("turns").alias("place", "t")).select(
        "conv_id", "block", "place", "t.edit", "t.role", "t.text"
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage and repair of all conversations, as digests (a row per conv_id)."""
    report, whole = repair(damage(conversations))
    sha = digests(whole).withColumnRenamed("conv_id", "_of")
    own = report.withColumnRenamed("conv_id", "_id").join(sha, F.expr("_id <=> _of"))
    every = conversations.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    return every.join(own, F.expr("conv_id <=> _id"), "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


# --- SQL ----------------------------------------------------------------------------------


def oracle_sql() -> str:
    """DuckDB SQL for ``repair_damaged``: the grammar's automaton, turn by turn,
    with (cost, audit, lines) of each phase (CRC-32 from its polynomial)."""
    far = 1_000_000

    def step(state: str, letters: str, cost: str, line: str = "") -> str:
        lines = f"{state}.x || [{line}]" if line else f"{state}.x"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}', 'x': {lines}}}"

    able = f"CASE WHEN must THEN {far} ELSE cut END"
    keep = {i: f"CASE WHEN initial = '{i}' THEN {able} ELSE {far} END" for i in "sua"}
    own, user, assistant = "role || ':' || body", "'user:' || body", "'assistant:' || body"
    to_user, to_assistant = ("p0", "ps", "pa"), ("pu",)
    choices = {
        "p0": [step("p0", "D", "3")],
        "ps": [step("ps", "D", "3"), step("p0", "K", keep["s"], own)],
        "pu": [
            step("pu", "D", "3"),
            *[step(p, "ID", "5", "'user:'") for p in to_user],
            *[step(p, "K", keep["u"], own) for p in to_user],
            *[step(p, "R", f"2 + {able}", user) for p in to_user],
            *[step(p, "IK", f"2 + {keep['u']}", f"'assistant:', {own}") for p in to_assistant],
            *[step(p, "IR", f"4 + {able}", f"'assistant:', {user}") for p in to_assistant],
        ],
        "pa": [
            step("pa", "D", "3"),
            *[step(p, "ID", "5", "'assistant:'") for p in to_assistant],
            *[step(p, "K", keep["a"], own) for p in to_assistant],
            *[step(p, "R", f"2 + {able}", assistant) for p in to_assistant],
            *[step(p, "IK", f"2 + {keep['a']}", f"'user:', {own}") for p in to_user],
            *[step(p, "IR", f"4 + {able}", f"'user:', {assistant}") for p in to_user],
        ],
    }
    moved = ",\n      ".join(f"list_sort([{', '.join(c)}])[1] AS {p}" for p, c in choices.items())
    unreached = f"{{'c': {far}, 'a': '', 'x': []::VARCHAR[]}}"
    ends = ", ".join(
        [step("p0", "", "0"), step("pa", "", "0"), step("pu", "I", "2", "'assistant:'"), step("ps", "II", "4", "'user:', 'assistant:'")]
    )
    signs = r"[^\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE crc_steps(i, c, step) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM crc_steps WHERE step < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8),
kinds AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(
        regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
        lambda x: ('0x'||x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM conversations, crc_table),
damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body
  FROM kinds, range(2) copies(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(body)) AS i,
    regexp_extract(body, '({signs})[\\x20\\x09-\\x0D]*$', 1) AS sign,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS initial
  FROM damaged),
seen AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY i) > 1 AS again FROM placed),
turns AS MATERIALIZED (
  SELECT conv_id, turn, role, body, i, initial, sign = '' AS blank, sign <> '' AND again AS duplicate,
    sign <> '' AND NOT again AND sign NOT IN ('.', '!', '?') AS truncated,
    sign = '' OR again AS must, (sign <> '' AND NOT again AND sign NOT IN ('.', '!', '?'))::BIGINT AS cut,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM seen),
walk(conv_id, i, p0, ps, pu, pa) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 'x': []::VARCHAR[]}},
    {unreached}::STRUCT(c BIGINT, a VARCHAR, x VARCHAR[]), {unreached}::STRUCT(c BIGINT, a VARCHAR, x VARCHAR[]),
    {unreached}::STRUCT(c BIGINT, a VARCHAR, x VARCHAR[])
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT walk.conv_id, turns.i,
      {moved}
  FROM walk JOIN turns ON walk.conv_id IS NOT DISTINCT FROM turns.conv_id AND turns.i = walk.i + 1),
last_step AS (
  SELECT conv_id, list_sort([{ends}])[1] AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM walk) WHERE back = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    sum(blank::BIGINT)::BIGINT AS blank, sum(duplicate::BIGINT)::BIGINT AS duplicate, sum(truncated::BIGINT)::BIGINT AS truncated,
    sum((before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT)::BIGINT AS illegal
  FROM turns GROUP BY conv_id)
SELECT last_step.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(array_to_string(best.x, chr(10))) AS repaired_sha256
FROM last_step LEFT JOIN counts ON last_step.conv_id IS NOT DISTINCT FROM counts.conv_id"""
