"""Repair of conversations' structure by iterative-deepening A*.

Roles have to spell ``(s?(ua)+)?`` by their first letters: an optional system row, then user and assistant in turns.
Edits of a row, in ASCII order of their letters: Delete (2; the only one for blank and duplicate rows), Insert an empty
user or assistant row before it (5), Keep (0), Rerole to user or assistant (1); a truncated row that isn't deleted adds 5.
The audit is the string of letters of the cheapest edits, the ASCII-least of several.

The search goes depth first in ASCII order under a cost bound.  A table holds what is known of each state (row, role
so far): no repair from there costs less.  A failed state raises its entry, the entry of the start is the next bound; the
first accepting path under the least sufficient bound is the answer.  Conversations of over ``WHOLE`` rows are searched
in segments, for every role that one may begin and end with, and the cheapest chain of segments is taken: the same
audit, in time that grows with the rows.

Rows are ordered by turn (nulls first), then role and MD5 of role and text, and stream through the tasks sorted by
conversation: of a row one letter is held, texts never are.  Copies of a row are counted before the shuffle, and where a
row was first seen comes from an aggregate, so no set of a conversation's texts is held either.

Defined cases
* null roles and texts are one space: such a text is blank, such a role spells nothing and can only be deleted or reroled.
* null conv_ids are one conversation; null turns come first and don't count for gaps.
* repeated rows: all but the first are duplicates; rows of the same turn follow each other in the order above.
* a conversation without rows has no result here (the query adds it); an empty table gives an empty result.
* very long texts and conversations are taken whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.session import checkpointed, ship

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SOUND, GONE, CUT = 0, 1, 2  # a row's fault: none, must be deleted, truncated
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
WHOLE, SEGMENT = 512, 64  # rows searched at once, and of each part of a longer conversation
NAMES = {USER: "user", ASSISTANT: "assistant"}
_KEEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def steps(letter: str, fault: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, state after it, rows consumed) of one row, in ASCII order."""
    out = [("D", DELETE, state, 1), ("I", INSERT, _TURN[state], 0)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if (letter, state) in _KEEP:
            out.append(("K", more, _KEEP[letter, state], 1))
        out.append(("R", REROLE + more, _TURN[state], 1))
    return out


STEPS = {(x, f): [steps(x, f, s) for s in range(4)] for x in "sua?" for f in (SOUND, GONE, CUT)}
_LAST = [[("I", INSERT, _TURN[s], 0)] for s in range(4)]


def cheapest(rows: list[tuple[str, int]], begin: int, ends: tuple[int, ...]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits that lead from a state to one of ``ends``, the ASCII-least of several."""
    n = len(rows)
    moves = [STEPS[r] for r in rows] + [_LAST]
    known = [[0] * 4 for _ in range(n + 1)]  # no way from (row, state) is cheaper
    for i in range(n - 1, -1, -1):
        known[i] = [known[i + 1][0] + (DELETE if rows[i][1] else 0)] * 4
    bound = known[0][begin]
    while True:
        # a frame: row, state, budget left, next move, least of the moves tried
        path: list[str] = []
        stack = [[0, begin, bound, 0, None]]
        while stack:
            i, s, left, at, least = frame = stack[-1]
            if at == 0 and i == n and s in ends:
                return bound - left, "".join(path)
            options = moves[i][s]
            if at < len(options):
                edit, cost, to, used = options[at]
                frame[3] += 1
                if cost + known[i + used][to] <= left:
                    path.append(edit)
                    stack.append([i + used, to, left - cost, 0, None])
                    frame[4] = (edit, least)  # settled when the child has failed
                else:
                    frame[4] = _less(least, cost + known[i + used][to])
                continue
            known[i][s] = max(known[i][s], _value(least))
            stack.pop()
            if stack:
                path.pop()
                parent = stack[-1]
                cost = parent[2] - left
                parent[4] = _less(parent[4][1], cost + known[i][s])
        bound = known[0][begin]


def _less(a: int | None, b: int) -> int:
    return b if a is None or b < a else a


def _value(x: int | None) -> int:
    return 1 << 60 if x is None else x


def audit(rows: list[tuple[str, int]], whole: int = WHOLE, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of a conversation's (letter, fault) rows."""
    if len(rows) <= whole:
        return cheapest(rows, START, (START, ASSISTANT))
    best = {START: (0, "")}
    for at in range(0, len(rows), segment):
        part, last = rows[at : at + segment], at + segment >= len(rows)
        new: dict[int, tuple[int, str]] = {}
        for s, (cost, text) in best.items():
            for e in ((START, ASSISTANT) if last else range(4)):
                if e < s and e in (START, SYSTEM) or (s > SYSTEM and e == SYSTEM):
                    continue  # nothing leads back there
                if e == SYSTEM and s == START and not any(x == "s" and f != GONE for x, f in part):
                    continue
                c, t = cheapest(part, s, (e,))
                if e not in new or (cost + c, text + t) < new[e]:
                    new[e] = (cost + c, text + t)
        best = new
    return min(best[e] for e in (START, ASSISTANT) if e in best)


def rows_of(conversations: DataFrame) -> DataFrame:
    """(ck, conv_id, turn, role, text, h): nulls as one space; ck is the key of a conversation, null ones too."""
    ck = F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("c"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    plain = conversations.select(ck.alias("ck"), "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    return plain.withColumn("h", F.md5(F.concat_ws(":", F.char_length("role"), "role", "text")))


def order() -> list[Column]:
    return [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]


def structures(rows: DataFrame) -> DataFrame:
    """Each distinct row of a conversation's turn with the number of its copies and its faults, without the text."""
    body = F.btrim("text", F.lit(WHITE))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    short = rows.select("ck", "conv_id", "turn", "role", "h", (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    distinct = short.groupBy("ck", "conv_id", "turn", "role", "h", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    first = distinct.groupBy(F.col("ck").alias("f_ck"), F.col("role").alias("f_role"), F.col("h").alias("f_h")).agg(F.min(turn).alias("first"))
    met = distinct.join(first, (F.col("ck") == F.col("f_ck")) & (F.col("role") == F.col("f_role")) & (F.col("h") == F.col("f_h")))
    return met.select("ck", "conv_id", "turn", "role", "h", "blank", "truncated", "copies", (~turn.eqNullSafe(F.col("first"))).alias("seen"))


class Conversation:
    """What is held of a conversation while its rows pass."""

    def __init__(self, ck: str, conv_id) -> None:
        self.ck, self.conv_id = ck, conv_id
        self.rows: list[tuple[str, int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = None
        self.before = None

    def add(self, turn, role: str, blank: bool, truncated: bool, copies: int, seen: bool) -> None:
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        letter = role[:1]
        self.illegal += (self.before is not None and self.before + letter not in ("su", "ua", "au")) + (copies - 1 if letter + letter not in ("su", "ua", "au") else 0)
        self.before = letter
        again = copies - (not seen)
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else again
        self.truncated += not blank and not seen and truncated
        shown = letter if letter and letter in "sua" else "?"
        first = [] if seen else [(shown, GONE if blank else CUT if truncated else SOUND)]
        self.rows += first + [(shown, GONE)] * again

    def result(self) -> dict:
        cost, text = audit(self.rows)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"ck": self.ck, "conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": text}


def audited(schema: pa.Schema):
    """Over ``structures`` sorted by conversation: one row a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or r["ck"] != now.ck:
                    if now is not None:
                        out.append(now.result())
                    now = Conversation(r["ck"], r["conv_id"])
                now.add(r["turn"], r["role"], r["blank"], r["truncated"], r["copies"], r["seen"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    return run


def repair(conversations: DataFrame) -> DataFrame:
    """ck, conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation that has rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    ship(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType
    out = StructType([StructField("ck", StringType()), StructField("conv_id", kind), *[StructField(x, LongType()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], StructField("audit", StringType())])
    dealt = structures(rows_of(conversations)).repartition("ck").sortWithinPartitions(*order())
    return checkpointed(dealt.mapInArrow(audited(to_arrow_schema(out)), out))


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by conversation, the audit of each ahead: its repaired rows in order."""
    ck, letters, at, state, place = None, "", 0, START, 0
    names = ["ck", "place", "role", "text"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        out: list[tuple] = []

        def put(role: str, text: str) -> None:
            nonlocal place
            out.append((ck, place, role, text))
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(letters) and letters[at] == "I":
                at, state = at + 1, _TURN[state]
                put(NAMES[state], "")

        for r in batch.to_pylist():
            if r["audit"] is not None:
                ck, letters, at, state, place = r["ck"], r["audit"], 0, START, 0
                inserts()
                continue
            edit, at = letters[at], at + 1
            if edit == "K":
                state = _KEEP[r["role"][0], state]
                put(r["role"], r["text"])
            elif edit == "R":
                state = _TURN[state]
                put(NAMES[state], r["text"])
            inserts()
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def repaired(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """(ck, place, role, text): the repaired conversations.  The rows of each stand together in one partition, in order."""
    ship(conversations.sparkSession)
    rows = rows_of(conversations).select("ck", F.lit(1).alias("at"), "turn", "role", "h", "text", F.lit(None).cast("string").alias("audit"))
    ahead = audits.select("ck", F.lit(0).alias("at"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("h"), F.lit("").alias("text"), "audit")
    sort = order()
    return rows.unionByName(ahead).repartition("ck").sortWithinPartitions(sort[0], "at", *sort[1:]).mapInArrow(edited, "ck string, place bigint, role string, text string")


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, as its rows pass in order."""
    ck, digest = None, None
    for batch in batches:
        out: list[tuple[str, str]] = []
        for now, role, text in zip(*[batch.column(c).to_pylist() for c in ("ck", "role", "text")], strict=True):
            if now != ck:
                if digest is not None:
                    out.append((ck, digest.hexdigest()))
                ck, digest = now, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], names=["ck", "sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([ck]), pa.array([digest.hexdigest()])], names=["ck", "sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """(ck, sha256) of ``repaired`` rows; conversations without rows are missing."""
    return rows.mapInArrow(hashed, "ck string, sha256 string")
