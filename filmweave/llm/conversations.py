"""Repair of the turn structure of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``.

A conversation may open with a system turn; then user and assistant alternate and the assistant has the last word.
Turns are kept, given another role, deleted or put in; blank and repeated turns have to go, and a kept turn that breaks
off costs extra. Of the cheapest ways, the one whose edits spell the least text in ASCII is taken.

Rows are hash-partitioned by conversation and sorted within a partition; each conversation passes through a task as a
stream, twice. First come its turns without texts, last turn first: dynamic programming over four states (nothing
yet, after system, after user, after assistant) carries the costs of the rest of the conversation across Arrow
batches and leaves two bytes a turn, the choice from each state. Then the turns come again, first turn first, with their
texts: the choices are followed and the repaired text is hashed as it passes. Nothing else is held, so a conversation
of any length takes bounded memory; its choices are spilled to a scratch file of the task beyond a few megabytes, and
a lost task starts anew. The hash of a conversation's text is sequential, so one conversation is one task's work; tasks
combine nothing before. Repeated turns are found by a window over the same partitioning, which sorts and needs no shuffle.

Defined cases: a NULL role, text, id or turn reads as one blank where its text is asked for (so a NULL text is a blank
turn, and a NULL role can't be kept); turns ascend, NULL first; rows of one turn follow each other by role and text; NULL is a
conversation of its own; a conversation without rows left costs nothing; no rows, no result; texts of any length are
hashed as they pass; other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DROP, EMPTY, CUT, REPEAT, USER = range(5)  # damage by the remainder of CRC-32
REMAINDERS = 20
KEEP, REROLE, DELETE, INSERT, BROKEN_OFF = 0, 2, 3, 2, 1  # costs
BLANK, DUPLICATE, TRUNCATED, SOUND, GONE = range(5)  # the first fault of a row; GONE: the row is no longer there
_SPACE = " \t\n\x0b\f\r"
SPILL_BYTES = 8 << 20
SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER, (_USER, "a"): _ASSISTANT}
_WANTED = ("u", "u", "a", "u")  # the role that may be put in from each state
_END = (0, 2 * INSERT, INSERT, 0)
_TAIL = (0, 2, 1, 0)  # turns put in at the end
# All that may come before the next turn is dealt with, as texts in ASCII order; none is the start of another.
_CHOICES = ("D", "ID", "IID", "IIK", "IIR", "IK", "IR", "K", "R")
_ROLES = {"u": "user", "a": "assistant"}
SENT = ("conv_id", "no_conv_id", "again", "turn", "no_turn", "kind", "fault", "role", "said")


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after the damage; dropped rows stay, marked, so that their conversation is known."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % REMAINDERS
    text = F.when(kind == EMPTY, "").when(kind == CUT, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == USER, "user").otherwise(blank("role"))
    copies = F.when(kind == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (kind == DROP).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` in their order: ``at`` from 1 in each conversation, ``fault`` and ``kind``, the first letter of the role if it has a meaning.

    One shuffle, by conversation; both windows keep to that partitioning.
    """
    rows = rows.repartition("conv_id")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order))
    again = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("at")
    last = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    fault = (
        F.when(F.col("gone"), GONE).when(last == "", BLANK).when(F.row_number().over(again) > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )
    first = F.substring("role", 1, 1)
    return rows.withColumn("fault", fault).withColumn("kind", F.when(first.isin("s", "u", "a"), first).otherwise(""))


class Choices:
    """A stack of choices, two bytes each; full blocks go to a scratch file of the task and come back in reverse."""

    def __init__(self, most: int = SPILL_BYTES) -> None:
        self.block, self.most, self.spilled, self.file = bytearray(), most, 0, None

    def push(self, pair: bytes) -> None:
        self.block += pair
        if len(self.block) >= self.most:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.spilled * self.most)
            self.file.write(self.block)
            self.spilled += 1
            self.block = bytearray()

    def pop(self) -> bytes:
        if not self.block:
            self.spilled -= 1
            self.file.seek(self.spilled * self.most)
            self.block = bytearray(self.file.read(self.most))
        pair = bytes(self.block[-2:])
        del self.block[-2:]
        return pair


@cache
def _best(kind: str, fault: int, rest: tuple[int, ...]) -> tuple[tuple[int, ...], int, bytes]:
    """The costs from each state with one turn more in front, less their minimum; that minimum; the choice for each state.

    ``rest`` has the costs of what follows. They differ by a few edits at most, so there are few cases to work out.
    """
    costs, picks = [], []
    for start in range(4):
        best = None
        for pick, letters in enumerate(_CHOICES):
            state, cost = start, INSERT * (len(letters) - 1)
            for _ in letters[1:]:
                state = _NEXT[state, _WANTED[state]]
            if letters[-1] == "D":
                cost += DELETE
            elif fault in (BLANK, DUPLICATE):
                continue
            else:
                role = kind if letters[-1] == "K" else _WANTED[state]
                state = _NEXT.get((state, role))
                if state is None:
                    continue
                cost += (KEEP if letters[-1] == "K" else REROLE) + (BROKEN_OFF if fault == TRUNCATED else 0)
            if best is None or cost + rest[state] < best[0]:
                best = (cost + rest[state], pick)
        costs.append(best[0])
        picks.append(best[1])
    least = min(costs)
    return tuple(c - least for c in costs), least, bytes((picks[0] << 4 | picks[1], picks[2] << 4 | picks[3]))


class Repair:
    """One conversation as it streams by: :meth:`back` for each turn from the last, then :meth:`forth` from the first."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.rest, self.cost = _END, 0
        self.choices = Choices()
        self.faults = [0] * 5
        self.illegal, self.later = 0, None
        self.low = self.high = self.seen = None
        self.turns = 0
        self.state, self.audit, self.hash, self.first = _START, bytearray(), hashlib.sha256(), True

    def back(self, kind: str, fault: int, turn) -> None:
        if fault == GONE:
            return
        self.faults[fault] += 1
        if self.later is not None and kind + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = kind
        if turn is not None:  # turns descend
            if self.high is None:
                self.high = turn
            if turn != self.low:
                self.turns += 1
            self.low = turn
        self.rest, more, pair = _best(kind, fault, self.rest)
        self.cost += more
        self.choices.push(pair)

    def _put(self, role: str, text: str) -> None:
        if not self.first:
            self.hash.update(b"\n")
        self.first = False
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def _insert(self) -> None:
        wanted = _WANTED[self.state]
        self._put(_ROLES[wanted], "")
        self.state = _NEXT[self.state, wanted]

    def forth(self, kind: str, fault: int, role: str, text: str) -> None:
        if fault == GONE:
            return
        pair = self.choices.pop()
        letters = _CHOICES[pair[self.state >> 1] >> (0 if self.state & 1 else 4) & 15]
        self.audit += letters.encode()
        for _ in letters[1:]:
            self._insert()
        if letters[-1] == "D":
            return
        if letters[-1] == "R":
            kind = _WANTED[self.state]
            role = _ROLES[kind]
        self._put(role, text)
        self.state = _NEXT[self.state, kind]

    def row(self) -> tuple:
        cost = self.cost + self.rest[_START]
        for _ in range(_TAIL[self.state]):
            self._insert()
            self.audit += b"I"
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        counts = (self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED])
        return (self.conv_id, gaps, *counts, self.illegal, cost, self.audit.decode(), self.hash.hexdigest())


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired conversations of a sorted partition; the state goes on across batches."""
    now: Repair | None = None
    for batch in batches:
        done = []
        for conv_id, no_id, again, turn, no_turn, kind, fault, role, text in zip(*(batch[c].tolist() for c in SENT), strict=True):
            conv_id = None if no_id else conv_id
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = Repair(conv_id)
            if again:
                now.forth(kind, fault, role, text)
            else:
                now.back(kind, fault, None if no_turn else turn)
        if done:
            yield _frame(done)
    if now is not None:
        yield _frame([now.row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows as a frame whose ids keep their NULLs and all 64 bits."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=columns, dtype="object").astype({c: "Int64" for c in columns[:-2]})


def repair(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``rows`` (``conv_id, turn, role, text, gone``): its faults, the edits and the repaired text's hash."""
    known = _with_faults(rows)
    back = F.struct(F.lit(False).alias("again"), (-F.col("at")).alias("place"), F.lit("").alias("said"))
    forth = F.struct(F.lit(True).alias("again"), F.col("at").alias("place"), F.col("text").alias("said"))
    twice = known.select("conv_id", "turn", "kind", "fault", "role", F.inline(F.array(back, forth)))
    twice = twice.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "again", "place")
    # A flag tells NULL, since pandas would make such a column floating.
    value = lambda c: (F.coalesce(c, F.lit(0)).alias(c), F.col(c).isNull().alias(f"no_{c}"))
    sent = twice.select(*value("conv_id"), "again", *value("turn"), "kind", "fault", "role", "said")
    return sent.mapInPandas(_stream, SCHEMA)
