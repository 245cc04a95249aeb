"""Repair of the turn structure of conversations, by secondary-sorted streaming.

Each conversation's rows go to one task, sorted by turn, and pass through
``mapInPandas`` as a stream; what is carried from one Arrow batch to the next
is the state of a dynamic programme, never the rows.

* First stream, last turn first, on narrow rows: the least cost still to come
  from each of four states (nothing yet, after ``s``, ``u`` and ``a``).  A row
  leaves one byte, the best edit in each state (two bits each).  These
  backpointers leave the task in chunks, as rows of a table in the shared
  folder, so a conversation of any length holds one chunk at a time.
* Second stream, first turn first: the chunks, sorted in among the rows that
  they speak of, are followed and the edits made.

A letter leads from a state to one state only, so taking the least letter among
the cheapest edits from the front on gives the ASCII-least cheapest audit.

Edits: Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert of an
empty turn 5; an undeleted row that is cut off costs 5 more, and a row that is
blank or repeats an earlier one of its conversation has to go.  The roles left
have initials ``(s?(ua)+)?``.

Nulls: a null role or text is one space; a null turn comes first; a null
conv_id is one conversation.  Rows of one turn are ordered by role, then by the
text's SHA-256; rows that repeat entirely are told apart by nothing and the
first is the earlier one.  Texts of any length pass whole.  Other columns are
not looked at.  Without rows there are no conversations.
"""

from __future__ import annotations

import functools
import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Cost of each edit, letters in ASCII order, and of keeping a row that is cut off.
COST, CUT = {"D": 2, "I": 5, "K": 0, "R": 1}, 5
LETTERS = "DIKR"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted (or reroled) turn, from each state.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: What a kept row of each initial leads to.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = ("su", "ua", "au")
NEVER = 1 << 40
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

VISIBLE = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

ORDER = ["known", "turn", "role", "digest"]
PLAN_SCHEMA = ("key string, known boolean, turn long, role string, digest binary, kind int, chunk long, choices binary, "
               "gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


# ------------------------------------------------------------ the programme
def _inserted(costs: list[int]) -> list[int]:
    """Least costs if turns may also be inserted first."""
    out = list(costs)
    for _ in range(3):
        out = [min(c, COST["I"] + out[FOLLOWS[q]]) for q, c in enumerate(out)]
    return out


#: Cost to come after the last row: nothing, or a whole number of exchanges.
AT_END = tuple(_inserted([0, NEVER, NEVER, 0]))


def moves(state: int, initial: str, fault: int) -> dict[str, tuple[int, int]]:
    """letter -> (cost, state after) of the edits that a row allows."""
    out = {"D": (COST["D"], state)}
    if fault not in (BLANK, DUPLICATE):
        more = CUT if fault == TRUNCATED else 0
        out["R"] = (COST["R"] + more, FOLLOWS[state])
        if state in KEPT.get(initial, {}):
            out["K"] = (COST["K"] + more, KEPT[initial][state])
    return out


@functools.lru_cache(1 << 16)
def backwards(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int, int]:
    """(costs to come before the row, less what all have in common; that
    common part; the byte of best edits) from the costs after it."""
    options = [{x: c + after[to] for x, (c, to) in moves(q, initial, fault).items()} for q in range(4)]
    best = _inserted([min(o.values()) for o in options])
    byte = 0
    for q in range(4):
        letter = next(x for x in LETTERS
                      if (COST["I"] + best[FOLLOWS[q]] if x == "I" else options[q].get(x, NEVER)) == best[q])
        byte |= LETTERS.index(letter) << 2 * q
    low = min(best)
    return tuple(c - low for c in best), low, byte


# ------------------------------------------------------------- first stream
class _Plan:
    """The state that the first stream carries within a conversation."""

    def __init__(self, key: str, chunk: int):
        self.key, self.chunk = key, chunk
        self.costs, self.common = AT_END, 0
        self.choices, self.chunks = bytearray(), 0
        self.first = self.last = self.after = self.at = self.held = None
        self.turns = self.illegal = 0
        self.faults = [0] * 4

    def add(self, known: bool, turn: int, role: str, digest: bytes, first_known, first_turn, fault: int) -> list:
        """A row, last first.  (first_known, first_turn): where its role and
        text stood first, if more than once."""
        self.settle((known, turn, role, digest))
        later = first_turn is not None and (first_known, first_turn) < (known, turn)
        self.held = [(known, turn, role, digest), DUPLICATE if later and fault != BLANK else fault]
        if known:
            self.turns += self.last != turn
            self.first = turn if self.first is None else self.first
            self.last = turn
        return self.flush() if len(self.choices) >= self.chunk else []

    def settle(self, earlier=None):
        """Take the row held back: it repeats the one before it if that is the same."""
        if self.held is None:
            return
        at, fault = self.held
        if earlier == at and fault != BLANK:
            fault = DUPLICATE
        self.faults[fault] += 1
        initial = at[2][:1]
        self.illegal += self.after is not None and initial + self.after not in LEGAL
        self.after, self.at, self.held = initial, at, None
        self.costs, low, byte = backwards(self.costs, initial, fault)
        self.common += low
        self.choices.append(byte)

    def flush(self) -> list:
        if not self.choices:
            return []
        row = (self.key, *self.at, 1, self.chunks, bytes(reversed(self.choices)), *[0] * 6)
        self.chunks, self.choices = self.chunks + 1, bytearray()
        return [row]

    def close(self) -> list:
        self.settle()
        gaps = 0 if self.first is None else self.first - self.last + 1 - self.turns
        _, blank, duplicate, truncated = self.faults
        return [*self.flush(), (self.key, False, 0, "", b"", 0, 0, b"", gaps, blank, duplicate, truncated,
                                int(self.illegal), self.common + self.costs[NOTHING])]


def _rows(pdf: pd.DataFrame, columns: list[str]) -> Iterator[tuple]:
    return zip(*(pdf[c].tolist() for c in columns), strict=True)


def _planner(chunk: int) -> Callable:
    names = [c.split()[0] for c in PLAN_SCHEMA.split(", ")]

    def run(batches):
        plan = None
        for pdf in batches:
            out = []
            for key, known, turn, role, digest, again, first_known, first_turn, fault in _rows(
                    pdf, ["key", *ORDER, "again", "first_known", "first_turn", "fault"]):
                if plan is None or key != plan.key:
                    out += plan.close() if plan else []
                    plan = _Plan(key, chunk)
                out += plan.add(known, turn, role, digest, first_known if again else None, first_turn if again else None, fault)
            if out:
                yield pd.DataFrame(out, columns=names)
        if plan:
            yield pd.DataFrame(plan.close(), columns=names)

    return run


# ------------------------------------------------------------ second stream
def _edits(state: int, byte: int | None) -> Iterator[tuple[str, int]]:
    """(letter, state after) of the inserts ahead of a row and of its own edit
    but for Keep, whose state the row gives; at the end the inserts alone."""
    if byte is None:
        while state in (SYSTEM, USER):
            state = FOLLOWS[state]
            yield "I", state
        return
    while LETTERS[byte >> 2 * state & 3] == "I":
        state = FOLLOWS[state]
        yield "I", state
    yield LETTERS[byte >> 2 * state & 3], state


def _followed(batches, begin, edit, end) -> Iterator[list]:
    """Follow the backpointers: ``begin(header)`` gives what a conversation
    carries, ``edit(carried, letter, role, text)`` and ``end(carried)`` lists of rows."""
    carried, state, choices = None, NOTHING, deque()

    def done():
        out = []
        for letter, to in _edits(state, None):
            out += edit(carried, letter, ROLE_OF[to], "")
        return out + end(carried)

    for pdf in batches:
        out = []
        for kind, role, text, given, *header in _rows(pdf, ["kind", "role", "text", "choices", "key", *COUNTS]):
            if kind == 0:
                out += done() if carried is not None else []
                carried, state, choices = begin(header), NOTHING, deque()
            elif kind == 1:
                choices.append(iter(given))
            else:
                while (byte := next(choices[0], None)) is None:
                    choices.popleft()
                for letter, to in _edits(state, byte):
                    state = to
                    if letter == "I":
                        out += edit(carried, "I", ROLE_OF[to], "")
                    elif letter == "D":
                        out += edit(carried, "D", role, text)
                    elif letter == "R":
                        state = FOLLOWS[state]
                        out += edit(carried, "R", ROLE_OF[state], text)
                    else:
                        state = KEPT[role[:1]][state]
                        out += edit(carried, "K", role, text)
        yield out
    if carried is not None:
        yield done()


def _turns(batches):
    def edit(carried, letter, role, text):
        if letter == "D":
            return []
        carried[1] += 1
        return [(carried[0], carried[1] - 1, letter, role, text)]

    for out in _followed(batches, lambda header: [header[0], 0], edit, lambda carried: []):
        if out:
            yield pd.DataFrame(out, columns=["key", "position", "edit", "role", "text"])


def _digests(batches):
    def edit(carried, letter, role, text):
        _, audit, hashed, _ = carried
        if letter != "D":
            hashed.update(f"{carried[3]}{role}:{text}".encode())
            carried[3] = "\n"
        audit.extend(letter.encode())
        return []

    def end(carried):
        header, audit, hashed, _ = carried
        return [(*header, audit.decode(), hashed.hexdigest())]

    for out in _followed(batches, lambda header: [header, bytearray(), hashlib.sha256(), ""], edit, end):
        if out:
            yield pd.DataFrame(out, columns=["key", *COUNTS, "audit", "repaired_sha256"])


# ----------------------------------------------------------------- the whole
def _keyed(turns: DataFrame) -> DataFrame:
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


class Repair:
    """The repair of ``turns`` (conv_id, turn, role, text): plans are made and
    written at once, what they say is made out by ``turns`` and ``summary``.
    ``chunk``: backpointers in a row of the plan."""

    def __init__(self, turns: DataFrame, chunk: int = 1 << 16):
        self.scratch = common.Scratch(turns.sparkSession, "turns")
        self.kind = turns.schema["conv_id"].dataType
        self.tasks = common.partitions(turns.sparkSession)
        self.rows = _keyed(turns)
        fault = (F.when(~F.col("text").rlike(VISIBLE), BLANK).when(~F.col("text").rlike(ENDED), TRUNCATED).otherwise(SOUND))
        narrow = self.rows.select("key", *ORDER, fault.alias("fault"))
        said = ["key", "role", "digest"]
        first = F.min(F.struct("known", "turn")).alias("first")
        again = narrow.groupBy(*said).agg(F.count("*").alias("n"), first).where("n > 1").select(
            *said, F.lit(True).alias("again"), F.col("first.known").alias("first_known"), F.col("first.turn").alias("first_turn"))
        given = narrow.join(again, said, "left").select(
            "key", *ORDER, F.coalesce("again", F.lit(False)).alias("again"), F.coalesce("first_known", F.lit(False)).alias("first_known"),
            F.coalesce("first_turn", F.lit(0)).alias("first_turn"), "fault")
        ordered = given.repartition(self.tasks, "key").sortWithinPartitions("key", *(F.col(c).desc() for c in ORDER))
        self.plan = self.scratch.write(ordered.mapInPandas(_planner(chunk), PLAN_SCHEMA), "plan")

    def _ordered(self) -> DataFrame:
        rows = self.rows.withColumn("kind", F.lit(2)).unionByName(self.plan, allowMissingColumns=True)
        zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ["chunk", *COUNTS]}
        both = rows.select(*(zero.get(c, F.col(c)) for c in rows.columns))
        return both.repartition(self.tasks, "key").sortWithinPartitions("key", *ORDER, "kind", F.col("chunk").desc())

    def _conv_id(self) -> Column:
        return F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(self.kind).alias("conv_id")

    def turns(self) -> DataFrame:
        """The repaired turns: conv_id, position (from 0), edit, role, text."""
        made = self.scratch.write(self._ordered().mapInPandas(
            _turns, "key string, position long, edit string, role string, text string"), "turns")
        return made.select(self._conv_id(), "position", "edit", "role", "text")

    def summary(self) -> DataFrame:
        """A row per conversation: its faults, cost, audit (the edits' initials)
        and the SHA-256 of the repaired ``role:text`` lines."""
        schema = "key string, " + "".join(f"{c} long, " for c in COUNTS) + "audit string, repaired_sha256 string"
        made = self.scratch.write(self._ordered().mapInPandas(_digests, schema), "summary")
        return made.select(self._conv_id(), *COUNTS, "audit", "repaired_sha256")


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults of the operator's query, told by a hash of
    conversation and turn: of 20 rows one is dropped, one emptied, one loses its
    sentence ends, one stands twice and one becomes the user's."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")) % 20
    drawn = conversations.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), draw.alias("draw"))
    copies = F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)
    text = (F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return drawn.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """The summary of ``damaged`` for every conversation of ``conversations``."""
    found = Repair(damaged).summary().withColumnRenamed("conv_id", "of")
    every = conversations.select("conv_id").distinct()
    none = hashlib.sha256().hexdigest()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
