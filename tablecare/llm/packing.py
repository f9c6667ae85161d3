"""Best-fit packing of documents into sequences, from the histogram of their lengths.

Patterns of up to three lengths that fill a sequence are enumerated over length classes; non-negative least squares fits how often each
is used, so that the patterns add up to the histogram; the counts are rounded down. What is left, and what room the patterns leave,
is packed best-fit from long to short, by runs of equal lengths. All of this works on at most ``capacity`` numbers, however many
documents there are. The documents of a length are then numbered by Spark, and the number decides the place.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tablecare.llm.word_bpe import word_ids
from tablecare.session import cut_lineage

CAPACITY = 4096
END_ID = 1

CLASSES = 128
"""Length classes of the fit: patterns are sums of classes, each the longest length in it."""

ROWS_PER_GROUP = 1000
"""Documents of one length are numbered in groups of about so many, so no length is one task's work."""


def pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, cut into pieces of at most ``capacity`` tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    end = struct.pack("<I", END_ID)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(shared.value).encode
        for batch in batches:
            rows, found = [], []
            for row, value in enumerate(batch.column(1)):
                ids = encode(value.as_py() or "") + end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    found.append((number, at // 4, len(part) // 4, zlib.crc32(part)))
            if found:
                number, start, length, crc = zip(*found)
                taken = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken, pa.array(number, pa.int32()), *[pa.array(c, pa.int64()) for c in (start, length, crc)]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(cut, schema)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """The ``x >= 0`` that minimises ``|a x - b|``, by the active-set method of Lawson and Hanson."""
    gram, aim = a.T @ a, a.T @ b
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        slope = aim - gram @ x
        slope[used] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-10 * max(1e-300, np.abs(aim).max()):
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            tried = np.linalg.solve(gram[np.ix_(at, at)] + 1e-12 * np.eye(len(at)), aim[at])
            if (tried > 0).all():
                x[:] = 0
                x[at] = tried
                break
            down = tried <= 0
            step = np.min(x[at][down] / np.maximum(x[at][down] - tried[down], 1e-300))
            x[at] += step * (tried - x[at])
            gone = at[down & (x[at] <= 1e-15 * max(1.0, x.max()))]
            gone = gone if len(gone) else at[down][:1]
            x[gone], used[gone] = 0, False
    return x


def patterns(classes: int) -> list[tuple[int, ...]]:
    """Every way to fill a sequence of ``classes`` units with up to three classes."""
    found = [(classes,)] + [(a, classes - a) for a in range((classes + 1) // 2, classes)]
    return found + [(a, b, classes - a - b) for a in range(1, classes) for b in range(1, a + 1) if 1 <= classes - a - b <= b]


@dataclass
class Group:
    """``count`` sequences alike: (length, times) of what lies in each, and the room that is left."""

    count: int
    content: list[tuple[int, int]]
    room: int


def _fitted(histogram: dict[int, int], capacity: int, classes: int) -> tuple[list[Group], dict[int, int]]:
    """The sequences that the fitted patterns give, and the lengths that are left."""
    width = -(-capacity // classes)
    left = {n: c for n, c in histogram.items() if c}
    stock: dict[int, list[list[int]]] = {}
    for n in sorted(left):
        stock.setdefault(-(-n // width), []).append([n, left[n]])
    ways = patterns(capacity // width) if stock else []
    rows = -(-capacity // width)
    a, b = np.zeros((rows, len(ways))), np.zeros(rows)
    for j, way in enumerate(ways):
        for k in way:
            a[k - 1, j] += 1
    for k, runs in stock.items():
        b[k - 1] = sum(c for _, c in runs)
    repeats = np.floor(nonnegative_least_squares(a, b / max(b.sum(), 1)) * b.sum() + 1e-6).astype(np.int64) if stock else []
    groups = []
    for way, repeat in zip(ways, repeats):
        have = {k: sum(c for _, c in stock.get(k, [])) for k in set(way)}
        repeat = min([int(repeat), *[have[k] // way.count(k) for k in have]])
        slots = []
        for k in way if repeat else ():
            need, runs = repeat, []
            while need:
                n, c = stock[k][-1]
                taken = min(c, need)
                runs.append([n, taken])
                need -= taken
                stock[k][-1][1] -= taken
                if not stock[k][-1][1]:
                    stock[k].pop()
            slots.append(runs)
        while slots and slots[0]:
            count = min(s[0][1] for s in slots)
            lengths = [s[0][0] for s in slots]
            groups.append(Group(count, [(n, 1) for n in lengths], capacity - sum(lengths)))
            for s in slots:
                s[0][1] -= count
                if not s[0][1]:
                    s.pop(0)
    return groups, {n: c for runs in stock.values() for n, c in runs if c}


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES) -> list[Group]:
    """Sequences for ``histogram`` (length -> documents): fitted patterns, then best fit of the rest, long before short."""
    groups, left = _fitted(histogram, capacity, min(classes, capacity))
    open_: dict[int, list[Group]] = {}
    for g in groups:
        open_.setdefault(g.room, []).append(g)
    rooms = sorted(open_)

    def put(g: Group) -> None:
        if g.room not in open_:
            bisect.insort(rooms, g.room)
        open_.setdefault(g.room, []).append(g)

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                fresh = [Group(todo // per, [(length, per)], capacity - per * length), Group(1, [(length, todo % per)], capacity - todo % per * length)]
                for g in fresh:
                    if g.count and g.content[0][1]:
                        put(g)
                break
            room = rooms[at]
            g = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            per = room // length
            whole, rest = min(g.count, todo // per), 0
            if whole:
                put(Group(whole, [*g.content, (length, per)], room - per * length))
            todo -= whole * per
            if whole < g.count and todo:
                rest = min(todo, per)
                put(Group(1, [*g.content, (length, rest)], room - rest * length))
                todo -= rest
            if g.count - whole - (rest > 0):
                put(Group(g.count - whole - (rest > 0), g.content, room))
    return [g for same in open_.values() for g in same]


def placements(groups: list[Group]) -> np.ndarray:
    """Rows (length, first number, first sequence, documents per sequence, offset), sorted: where numbered documents of a length go."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for g in groups:
        offset = 0
        for length, times in g.content:
            rows.append((length, taken.get(length, 0), sequence, times, offset))
            taken[length] = taken.get(length, 0) + g.count * times
            offset += length * times
        sequence += g.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _numbered(cut: DataFrame, most: int) -> DataFrame:
    """The pieces with a gapless number ``number`` from 0 within each length."""
    buckets = -(-most // ROWS_PER_GROUP)
    filed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = filed.groupBy("length", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    starts = sizes.select("length", "bucket", before.alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return filed.withColumn("within", F.row_number().over(inside)).join(starts, ["length", "bucket"]).withColumn("number", F.col("before") + F.col("within") - 1)


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """A place for every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and becomes the end id alone. Repeated rows and null ids are documents like any other; an empty table gives no
    row. ``vocabulary`` is the JSON text of a tokenizer. The driver gets the histogram (``capacity`` rows at most) and sends back the
    placements, whose number depends on the lengths that occur and not on the number of documents.
    """
    cut = cut_lineage(pieces(docs, vocabulary, doc_id, text, capacity))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    placed = placements(pack_histogram(histogram, capacity))
    keys = placed[:, 0] * (1 << 50) + placed[:, 1]
    table = docs.sparkSession.sparkContext.broadcast((keys, placed))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, placed = table.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = placed[np.searchsorted(keys, length * (1 << 50) + number, "right") - 1] if len(number) else placed[:0]
            at = number - row[:, 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 2] + at // row[:, 3]), pa.array(row[:, 4] + at % row[:, 3] * length)], [*out.split()])

    out = "doc_id piece start length ids_crc32 sequence_id offset"
    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    numbered = _numbered(cut, max(histogram.values(), default=1))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, schema)
