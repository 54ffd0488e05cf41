"""Structure repair of conversations: the cheapest edits that make roles alternate.

Rows are dealt by conversation and sorted by turn, and ``mapInPandas`` streams them: the
state of a dynamic programme over the grammar ``(s?(ua)+)?`` of role initials is carried from
batch to batch. It has four states (nothing yet, after a system, a user, an assistant turn),
each with the cost of its cheapest edits so far and its place among the others in the order
of their edit strings, which settles ties without holding the strings. Per row one whole
number holds the backpointers of all states.

A conversation is traced back when it ends. One too large to be held (``giant_chars``) is
not: its rows go on to the shared folder with their backpointers, and are traced from there,
last row first, by a second stream that holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.support import bounded, prepare
from tabwright.scratch import stage

# Conversations with more characters are traced from the shared folder.
GIANT_CHARS = 16_000_000
# Counted lists (repeated turns, giant conversations) are broadcast up to this length.
BROADCAST_TURNS = 500_000

SPACE = " \t\n\x0b\x0c\r"
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States: nothing yet, after a system, a user, an assistant turn. What a user or assistant
# turn, as the grammar has it next, leads to; and where a kept initial leads.
NEXT = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLE_OF = {2: "user", 3: "assistant"}
# Edits before the end: the inserts that complete each state.
LAST = ("", "II", "I", "")
# A state that much above the cheapest one cannot win: from there its way costs 10 at most.
HOPELESS = 14
EDITS = ("D", "ID", "IK", "IR", "K", "R")

EDIT_FIELDS = (
    "no_conv boolean, conv long, place long, edit string, no_turn boolean, turn long, "
    "old_role string, role string, text string, fault string"
)
ROW_FIELDS = EDIT_FIELDS + ", back int"
SUMMARY_FIELDS = (
    "no_conv boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)

Costs = tuple[int | None, ...]
START: tuple[Costs, tuple[int, ...]] = ((0, None, None, None), (0, 0, 0, 0))


@lru_cache(maxsize=100_000)
def step(costs: Costs, ranks: tuple[int, ...], initial: str, fault: str) -> tuple[int, Costs, tuple[int, ...], int]:
    """One row: what all costs rise by, the new costs and ranks, and the backpointers.

    Of equally cheap edits the one least in ASCII order wins. Prefixes of unlike states end
    in a row's edit, so none begins another, and their order holds whatever follows.
    """
    best: list[tuple | None] = [None] * 4
    more = TRUNCATED if fault == "truncated" else 0
    for state, cost in enumerate(costs):
        if cost is None:
            continue
        for inserted, before in (("", state), ("I", NEXT[state])):
            so_far = cost + INSERT * len(inserted)
            ways = [("D", before, DELETE)]
            if fault not in ("blank", "duplicate"):
                ways.append(("R", NEXT[before], RENAME + more))
                if before in KEPT.get(initial, ()):
                    ways.append(("K", KEPT[initial][before], more))
            for edit, after, price in ways:
                way = (so_far + price, ranks[state], inserted + edit, state)
                if best[after] is None or way < best[after]:
                    best[after] = way
    least = min(w[0] for w in best if w is not None)
    alive = [w if w is not None and w[0] <= least + HOPELESS else None for w in best]
    order = sorted((w[1], w[2], i) for i, w in enumerate(alive) if w is not None)
    new_ranks = [0] * 4
    for rank, (_, _, i) in enumerate(order):
        new_ranks[i] = rank
    back = 0
    for i, w in enumerate(alive):
        if w is not None:
            back |= (w[3] | EDITS.index(w[2]) << 2) << (5 * i)
    return least, tuple(w[0] - least if w is not None else None for w in alive), tuple(new_ranks), back


def final_state(costs: Costs, ranks: tuple[int, ...]) -> int:
    ends = [(c + INSERT * len(LAST[i]), ranks[i], i) for i, c in enumerate(costs) if c is not None]
    return min(ends)[2]


class Course:
    """The programme's state within one conversation."""

    def __init__(self) -> None:
        self.rows = 0
        self.costs, self.ranks = START

    def take(self, role: str, fault: str) -> int:
        """Backpointers of the next row."""
        initial = role[:1] if role[:1] in KEPT else ""
        _, self.costs, self.ranks, back = step(self.costs, self.ranks, initial, fault)
        self.rows += 1
        return back

    def end(self) -> int:
        return final_state(self.costs, self.ranks)


def _insert(conv: tuple, place: int, state: int) -> tuple:
    return (*conv, place, "I", True, 0, None, ROLE_OF[state], "", None)


def last_edits(conv: tuple, rows: int, state: int) -> list[tuple]:
    """Inserts behind the last row, the last one first."""
    out = []
    for j, _ in enumerate(LAST[state]):
        state = NEXT[state]
        out.append(_insert(conv, 4 * rows + j, state))
    return out[::-1]


def edits_of(conv: tuple, at: int, row: tuple, back: int, state: int) -> tuple[list[tuple], int]:
    """The edits of row ``at``, last one first, when it ends in ``state``; and the state before."""
    own = back >> (5 * state)
    before, edit = own & 3, EDITS[own >> 2 & 7]
    no_turn, turn, role, text, fault = row
    new_role = {"D": None, "K": role, "R": ROLE_OF.get(state)}[edit[-1]]
    out = [(*conv, 4 * at + 2, edit[-1], no_turn, turn, role, new_role, text, fault)]
    if edit[0] == "I":
        out.append(_insert(conv, 4 * at, NEXT[before]))
    return out, before


def fault_of(text: str, repeated: bool) -> str | None:
    stripped = text.strip(SPACE)
    if not stripped:
        return "blank"
    if repeated:
        return "duplicate"
    return None if stripped[-1] in ".!?" else "truncated"


def _frame(rows: list[tuple], fields: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")], dtype=object)


def _faulty_rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, tuple, tuple]]:
    """Whether a conversation begins, its key, and (no_turn, turn, role, text, fault), row by row."""
    conv, last = None, None
    for batch in batches:
        columns = ["no_conv", "conv", "no_turn", "turn", "role", "text", "seen"]
        for no_conv, number, no_turn, turn, role, text, seen in zip(*[batch[c].tolist() for c in columns], strict=True):
            begins = conv != (no_conv, number)
            conv = (no_conv, number)
            here = (no_turn, turn, role, text)
            # Equal rows of a turn follow one another; ``seen`` tells of earlier turns.
            yield begins, conv, (*here, fault_of(text, seen or (not begins and here == last)))
            last = here


def _repair_held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of conversations that are held until they end."""
    out: list[tuple] = []
    held: list[tuple] = []
    course = Course()
    conv: tuple = ()

    def finish() -> Iterable[tuple]:
        state = course.end()
        edits = last_edits(conv, course.rows, state)
        for at in range(len(held) - 1, -1, -1):
            row, back = held[at]
            some, state = edits_of(conv, at, row, back, state)
            edits += some
        return reversed(edits)

    for begins, key, row in _faulty_rows(batches):
        if begins:
            if held:
                out += finish()
                if len(out) >= 400:
                    yield _frame(out, EDIT_FIELDS)
                    out = []
            held, course, conv = [], Course(), key
        held.append((row, course.take(row[2], row[4])))
    if held:
        out += finish()
    if out:
        yield _frame(out, EDIT_FIELDS)


def _with_backpointers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows as they come with their backpointers, and an end row with the final state."""
    out: list[tuple] = []
    course = Course()
    last: tuple = ()

    def end() -> tuple:
        return (*last, 4 * course.rows, "end", True, 0, None, None, None, None, course.end())

    for begins, conv, row in _faulty_rows(batches):
        if begins:
            if last:
                out.append(end())
            course, last = Course(), conv
        no_turn, turn, role, text, fault = row
        back = course.take(role, fault)
        out.append((*conv, 4 * course.rows - 2, "row", no_turn, turn, role, None, text, fault, back))
        if len(out) >= 400:
            yield _frame(out, ROW_FIELDS)
            out = []
    if last:
        out.append(end())
        yield _frame(out, ROW_FIELDS)


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits from rows with backpointers, last row first."""
    state = 0
    for batch in batches:
        out: list[tuple] = []
        for r in batch.itertuples(index=False):
            conv = (r.no_conv, r.conv)
            if r.edit == "end":
                state = r.back
                out += last_edits(conv, r.place // 4, state)
            else:
                row = (r.no_turn, r.turn, r.old_role, r.text, r.fault)
                some, state = edits_of(conv, r.place // 4, row, r.back, state)
                out += some
        yield _frame(out, EDIT_FIELDS)


def _keyed(conv: Column, name: str) -> list[Column]:
    """A whole number that may be null as two columns that may not: pandas would make it a float."""
    value = conv.cast("long")
    return [value.isNull().alias(f"no_{name}"), F.coalesce(value, F.lit(0)).alias(name)]


CONV = ["no_conv", "conv"]


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    giant_chars: int = GIANT_CHARS,
) -> DataFrame:
    """The edits of every conversation: conv_id, place, edit, turn, old_role, role, text and fault.

    One row per edit, ``place`` in order: K keeps a turn, R gives it the role user or
    assistant, D deletes it (role null), I inserts an empty turn of that role (turn, old_role
    and fault null). The rows but D's are the repaired conversation; rows of a conversation
    come together and in order, in one partition. A fault is ``blank`` (no character but
    ASCII space), ``duplicate`` (role and text of an earlier row) or ``truncated`` (does not
    end in ``.``, ``!`` or ``?``), the first that holds.

    Keeping costs 0, a new role 3, deleting 4 (blank and duplicate rows must go), inserting
    3, and a truncated row that stays 3 more. The edits are the cheapest that leave role
    initials of the form ``(s?(ua)+)?``; of equally cheap ones those whose letters are least
    in ASCII order. Rows go by turn, null first; rows of one turn by role and text. A null
    role or text counts as one space, null ids are one conversation. Other columns are not
    read; an empty table gives no rows.
    """
    prepare(turns.sparkSession)
    space = F.lit(" ")
    role, text = F.coalesce(F.col(role_col).cast("string"), space), F.coalesce(F.col(text_col).cast("string"), space)
    rows = turns.select(*_keyed(F.col(conv_col), "conv"), *_keyed(F.col(turn_col), "turn"), role.alias("role"), text.alias("text"))
    # Role and text with an earlier turn: only those of unlike turns travel, a row each.
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    keyed = rows.withColumn("said", said).withColumn("at", F.struct(~F.col("no_turn"), F.col("turn")))
    spans = keyed.groupBy(*CONV, "said").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    repeats = stage(spans.filter("first != last").drop("last"), "repeats")
    # A conversation that is no giant is in one task whole; so is each of the list's giants, in a stream.
    sizes = rows.groupBy(*CONV).agg(F.sum(F.length("text") + F.length("role") + 64).alias("chars"))
    giants = stage(sizes.filter(F.col("chars") > giant_chars).select(*CONV), "giants")

    known = keyed.join(bounded(repeats, BROADCAST_TURNS), [*CONV, "said"], "left")
    seen = F.coalesce(F.col("first") != F.col("at"), F.lit(False)).alias("seen")
    known = known.select(*CONV, "no_turn", "turn", "role", "text", seen)

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition(*CONV).sortWithinPartitions(*CONV, F.desc("no_turn"), "turn", "role", "text")

    if giants.isEmpty():
        edits = in_order(known).mapInPandas(_repair_held, EDIT_FIELDS)
    else:
        listed = bounded(giants, BROADCAST_TURNS)
        edits = in_order(known.join(listed, CONV, "left_anti")).mapInPandas(_repair_held, EDIT_FIELDS)
        large = in_order(known.join(listed, CONV, "left_semi")).mapInPandas(_with_backpointers, ROW_FIELDS)
        back = stage(large, "backpointers").repartition(*CONV).sortWithinPartitions(*CONV, F.desc("place"))
        traced = back.mapInPandas(_traced, EDIT_FIELDS)
        edits = edits.unionAll(traced.repartition(*CONV).sortWithinPartitions(*CONV, "place"))
    return edits.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias(conv_col), "place", "edit",
        F.when(~F.col("no_turn"), F.col("turn")).alias("turn"), "old_role", "role", "text", "fault",
    )


class Summary:
    """Counts, cost, audit and digest of one conversation, edit by edit."""

    def __init__(self, conv: tuple) -> None:
        self.conv = conv
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.distinct = 0
        self.lowest = self.highest = self.initial = None
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True

    def take(self, edit: str, no_turn: bool, turn: int, old_role: str, role: str, text: str, fault: str) -> None:
        self.audit.append(edit)
        self.cost += {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            self.cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
            if self.initial is not None and self.initial + old_role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = old_role[:1]
            if not no_turn:
                self.distinct += self.highest != turn
                self.lowest = turn if self.lowest is None else self.lowest
                self.highest = turn
        if edit != "D":
            self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.empty = False

    def row(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.distinct
        return (*self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now = None
    columns = ["no_conv", "conv", "edit", "no_turn", "turn", "old_role", "role", "text", "fault"]
    for batch in batches:
        out = []
        for no_conv, conv, *rest in zip(*[batch[c].tolist() for c in columns], strict=True):
            if now is None or now.conv != (no_conv, conv):
                if now is not None:
                    out.append(now.row())
                now = Summary((no_conv, conv))
            now.take(*rest)
        yield _frame(out, SUMMARY_FIELDS)
    if now is not None:
        yield _frame([now.row()], SUMMARY_FIELDS)


def repair_summary(edits: DataFrame, conv_col: str = "conv_id", clustered: bool = False) -> DataFrame:
    """A row per conversation of ``edits``: gaps, faults, illegal neighbours, cost, audit and digest.

    gaps counts whole numbers between the least and the greatest turn that no row has;
    illegal counts neighbours before the repair whose role initials are not su, ua or au;
    audit joins the edits' letters; repaired_sha256 digests ``role:text`` of the repaired
    turns, joined by newlines. ``clustered`` says that ``edits`` come as
    ``repair_conversations`` gives them; else they are dealt and sorted anew.
    """
    prepare(edits.sparkSession)
    rows = edits.select(
        *_keyed(F.col(conv_col), "conv"), "place", "edit", *_keyed(F.col("turn"), "turn"), "old_role", "role", "text", "fault"
    )
    if not clustered:
        rows = rows.repartition(*CONV).sortWithinPartitions(*CONV, "place")
    found = rows.mapInPandas(_summed, SUMMARY_FIELDS)
    return found.select(F.when(~F.col("no_conv"), F.col("conv")).alias(conv_col), *found.columns[2:])


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """conv_id, turn, role and text with planted faults, as crc32(conv_id:turn) % 20 says.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role
    user. Null counts as one space.
    """
    space = F.lit(" ")
    conv, turn = [F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col)]
    draw = F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20
    text = F.coalesce(F.col("text"), space)
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), draw.alias("draw"),
        F.when(draw == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), space)).alias("role"),
        F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    ).filter("draw != 0")
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies)).drop("col")
