"""Conversation structure repair: the cheapest edits that bring the turns of a conversation into order.

A conversation is in order if its role initials read ``(s?(ua)+)?``: at most one system turn, then user and assistant in turns. Every turn
is kept, given another role, or deleted, and empty turns may be inserted. Among the cheapest edits the one whose letters (``D`` delete,
``I`` insert, ``K`` keep, ``R`` rerole) are least in ASCII order is taken, so the answer is one.

The search is depth-first branch and bound with an explicit stack. A node is a place between two turns and the state of the order there.
Lower bounds of every suffix are found backwards from its end; the incumbent is the best finished (cost, audit); a table keeps the
best prefix of every node, and a worse one that comes later is left. The search ends when nothing on the stack can beat the incumbent.

Spark brings the turns of a conversation together in order, first as a few bytes each for the search, then with their texts as a stream
of rows, so a task holds one mark and one digest of each turn of the conversation it is at, never its texts. A conversation is one sequence
and its edits are one string, so its turns pass through one task.

Turns follow their number (nulls first), equal ones role and digest of the text. Null roles and texts are one space, a null
conversation id is a conversation of its own, repeated rows are repeated turns. An empty role has no initial that fits. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

DELETE, INSERT, REROLE, OPEN_END = 2, 5, 1, 5
"""Costs of the edits, and of a truncated turn that is not deleted; keeping costs nothing."""

START, SYSTEM, USER, ASSISTANT = range(4)
"""What stands before a place: nothing, a system turn, a user turn, an assistant turn."""

FOLLOWING = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
"""The state after a user or assistant turn is added, whichever fits."""

ROLES = {USER: "user", ASSISTANT: "assistant"}

SPACE = " \t\n\x0b\x0c\r"

FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t", "": "-"}


def _after_keep(state: int, initial: str) -> int | None:
    """The state behind a kept turn, or None if it does not fit."""
    if initial == "s":
        return SYSTEM if state == START else None
    return FOLLOWING[state] if initial == {USER: "u", ASSISTANT: "a"}[FOLLOWING[state]] else None


def _edits(state: int, initial: str, fault: str) -> list[tuple[str, int, int]]:
    """(letter, cost, state) of what can be done with the next turn."""
    found = [("D", DELETE, state)]
    if fault not in "bd":
        open_end = OPEN_END if fault == "t" else 0
        kept = _after_keep(state, initial)
        if kept is not None:
            found.append(("K", open_end, kept))
        found.append(("R", REROLE + open_end, FOLLOWING[state]))
    return found


_STEPS = {(state, initial, fault): _edits(state, initial, fault) for state in range(4) for initial in "sua-" for fault in "bdt-"}
_FAR = 1 << 60


def _relax(costs: list[int]) -> list[int]:
    """The bounds of the states of a place, given what follows without inserts there: one or two inserts may come first."""
    out = list(costs)
    for _ in range(3):
        out = [min(out[s], INSERT + out[FOLLOWING[s]]) for s in range(4)]
    return out


def suffix_bounds(initials: str, faults: str) -> list[list[int]]:
    """For every place and state, a cost below which the turns from there on cannot be brought into order."""
    bounds = [_relax([0, _FAR, _FAR, 0])]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        after = bounds[-1]
        bounds.append(_relax([min(cost + after[to] for _, cost, to in _STEPS[state, initial, fault]) for state in range(4)]))
    bounds.reverse()
    return bounds


class _Prefix:
    """Edits so far, as a chain that shares its past; compared only where costs are equal."""

    __slots__ = ("before", "letter", "size")

    def __init__(self, before: _Prefix | None, letter: str) -> None:
        self.before, self.letter = before, letter
        self.size = (before.size if before else 0) + 1

    def text(self) -> str:
        letters, at = [], self
        while at is not None:
            letters.append(at.letter)
            at = at.before
        return "".join(reversed(letters))


def _less(a: _Prefix | None, b: _Prefix | None) -> bool:
    """Whether the edits of ``a`` come before those of ``b`` in ASCII order; both end at one node with one cost, so neither begins the other."""
    if a is b:
        return False
    while a and b and a.size > b.size:
        a = a.before
    while a and b and b.size > a.size:
        b = b.before
    first = None
    while a is not b:
        first = (a.letter, b.letter) if a.letter != b.letter else first
        a, b = a.before, b.before
    return first is not None and first[0] < first[1]


def search(initials: str, faults: str) -> tuple[int, str]:
    """(cost, audit) of the best edits of turns with these initials (``s``, ``u``, ``a``, else ``-``) and faults (``b``, ``d``, ``t``, else ``-``)."""
    size, bounds = len(initials), suffix_bounds(initials, faults)
    best_cost, best = _FAR, None
    table: dict[tuple[int, int], tuple[int, _Prefix | None]] = {}
    stack: list[tuple[int, int, int, _Prefix | None]] = [(0, START, 0, None)]
    while stack:
        place, state, cost, prefix = stack.pop()
        if cost + bounds[place][state] > best_cost:
            continue
        known = table.get((place, state))
        if known is not None and (known[0] < cost or (known[0] == cost and not _less(prefix, known[1]))):
            continue
        table[place, state] = cost, prefix
        if place == size and state in (START, ASSISTANT) and (cost < best_cost or (cost == best_cost and _less(prefix, best))):
            best_cost, best = cost, prefix
        moves = [(letter, place + 1, to, cost + paid) for letter, paid, to in (_STEPS[state, initials[place], faults[place]] if place < size else ())]
        moves.append(("I", place, FOLLOWING[state], cost + INSERT))
        moves = [(total + bounds[at][to], letter, at, to, total) for letter, at, to, total in moves if total + bounds[at][to] <= best_cost]
        for _, letter, at, to, total in sorted(moves, key=lambda m: m[:2], reverse=True):
            stack.append((at, to, total, _Prefix(prefix, letter)))
    return best_cost, best.text() if best else ""


def apply_audit(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every turn that the edits leave; ``turns`` are (role, text) in order."""
    state, turns = START, iter(turns)
    for letter in audit:
        if letter == "I":
            state = FOLLOWING[state]
            yield letter, ROLES[state], ""
            continue
        role, text = next(turns)
        if letter == "K":
            state = SYSTEM if role[:1] == "s" else FOLLOWING[state]
            yield letter, role, text
        elif letter == "R":
            state = FOLLOWING[state]
            yield letter, ROLES[state], text


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plan_of(turns: Iterable[tuple[int | None, str, str, bytes]]) -> tuple:
    """The counts and the best edits of one conversation; ``turns`` are (turn, role initial, own fault, digest) in order."""
    seen: set[bytes] = set()
    initials, faults, illegal, last = [], [], 0, None
    lowest = highest = None
    numbers = 0
    for number, initial, fault, digest in turns:
        if number is not None:
            if number != highest:
                numbers += 1
            lowest, highest = number if lowest is None else lowest, number
        if fault != "b" and digest in seen:
            fault = "d"
        seen.add(digest)
        if last is not None and last + initial not in ("su", "ua", "au"):
            illegal += 1
        last = initial
        initials.append(initial if initial and initial in "sua" else "-")
        faults.append(fault)
    marks = "".join(faults)
    cost, audit = search("".join(initials), marks)
    gaps = highest - lowest + 1 - numbers if numbers else 0
    return gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit


def _runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """The consecutive rows of each key over all batches of a partition, as (key, rows); the rows must be read before the next key."""
    return groupby((row for batch in batches for part in _small(batch) for row in part.to_pylist()), key=lambda row: row[key])


def _small(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _written(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 4096, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _stream(df: DataFrame, schema: str, step: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """Run ``step`` over the batches of each partition; it gives rows as dicts."""
    kind = T._parse_datatype_string(schema)
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    fields = [(f.name, arrow[f.dataType]) for f in kind.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(step(batches), pa.schema(fields))

    return df.mapInArrow(run, kind)


def fault_of(text: Column) -> Column:
    """The fault that a text has by itself: ``b`` blank, ``t`` truncated (its last visible letter ends no sentence), else ``-``."""
    end = F.trim(text, F.lit(SPACE))
    return F.when(end == "", FAULTS["blank"]).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), FAULTS["truncated"]).otherwise(FAULTS[""])


def ordered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """The columns that the operator works on: conv (as text), turn, role, text, digest, gone.

    ``gone`` marks rows that are not turns but keep their conversation in the result.
    """
    said, who = F.coalesce(turns[text], F.lit(" ")), F.coalesce(turns[role], F.lit(" "))
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    columns = [turns[conv_id].cast("long").alias("conv"), turns[turn].cast("long").alias("turn"), who.alias("role"), said.alias("text")]
    return turns.select(*columns, digest.alias("digest"), (gone if gone is not None else F.lit(False)).alias("gone"))


def plan(turns: DataFrame) -> DataFrame:
    """One row per conversation of :func:`ordered_turns`: conv, counts of faults, cost and audit of the best edits.

    Only marks and digests of the turns are shuffled. ``gaps`` counts the numbers left out between the least and the greatest turn,
    ``illegal`` the neighbours whose initials are not su, ua or au; the first fault of a turn counts (blank, duplicate, truncated).
    """
    marks = turns.select("conv", "turn", "role", F.left("role", F.lit(1)).alias("initial"), fault_of(F.col("text")).alias("fault"), "digest", "gone")
    dealt = marks.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest").select("conv", "turn", "initial", "fault", "digest", "gone")

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        names = [f.split()[0] for f in PLAN.split(", ")]
        for conv, rows in _runs(batches, "conv"):
            found = _plan_of((r["turn"], r["initial"], r["fault"], r["digest"]) for r in rows if not r["gone"])
            yield {"conv": conv, **dict(zip(names, found))}

    return _stream(dealt, f"conv long, {PLAN}", step)


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The turns that the edits of ``plans`` (:func:`plan`) leave, in order: conv, place (from 0), edit, role, text.

    The rows of a conversation come one after another. A conversation without turns left has one row, with null place, edit, role and text.
    """
    none = F.lit(None).cast("string")
    edits = plans.select("conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), none.alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"))
    rows = turns.where(~F.col("gone")).select("conv", F.lit(1).alias("part"), "turn", "role", "text", "digest")
    dealt = edits.unionAll(rows).repartition("conv").sortWithinPartitions("conv", "part", F.asc_nulls_first("turn"), "role", "digest").select("conv", "part", "role", "text")

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for conv, run in _runs(batches, "conv"):
            audit, count = next(run)["text"], 0
            for count, (edit, role, text) in enumerate(apply_audit(audit, ((r["role"], r["text"]) for r in run)), 1):
                yield {"conv": conv, "place": count - 1, "edit": edit, "role": role, "text": text}
            if not count:
                yield {"conv": conv, "place": None, "edit": None, "role": None, "text": None}

    return _stream(dealt, "conv long, place long, edit string, role string, text string", step)


def digests(kept: DataFrame) -> DataFrame:
    """conv and repaired_sha256 of :func:`repaired` rows: the digest of ``role:text`` of its turns, joined by line breaks; without a shuffle."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for conv, rows in _runs(batches, "conv"):
            total = hashlib.sha256()
            for row in rows:
                if row["place"] is not None:
                    total.update(f"{chr(10) if row['place'] else ''}{row['role']}:{row['text']}".encode())
            yield {"conv": conv, "repaired_sha256": total.hexdigest()}

    return _stream(kept, "conv long, repaired_sha256 string", step)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, as :func:`ordered_turns`: by crc32 of ``conv_id:turn`` modulo 20, rows are dropped (0), emptied (1), freed of
    sentence ends (2), repeated (3) or said by the user (4)."""
    known = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text, role = F.coalesce(turns["text"], F.lit(" ")), F.coalesce(turns["role"], F.lit(" "))
    hurt = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.select(turns["conv_id"], turns["turn"], F.when(draw == 4, "user").otherwise(role).alias("role"), hurt.alias("text"), draw.alias("draw"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return ordered_turns(rows, gone=F.col("draw") == 0)
