"""Removal of long byte strings that occur more than once, by suffix order and longest-previous-factor arrays.

Sorting all suffixes of a corpus would move every byte many times. A string of ``WINDOW`` bytes always holds the same anchor, its
``ANCHOR`` bytes with the smallest hash, wherever it stands. So each text is cut into fragments, the runs of windows with one
anchor, and only fragments with equal anchors can share a window:

1. fragments whose anchor stands once leave; equal fragments are repeated as a whole and are settled by counting;
2. of anchors with different fragments one copy of each goes on with its bytes; an anchor with very many is split in two by the place of
   the anchor in the window, by the bytes that all windows of a half have in common, again and again, so no group is large;
3. a task sorts the suffixes of its groups to the depth of a window; in suffix order, the previous and next smaller position with a
   common prefix of that length is an earlier match (the longest previous factor is long enough).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tablecare.llm.line_dedup import _cleaning
from tablecare.llm.words import mix, powers, slices
from tablecare.session import cut_lineage

WINDOW = 400
ANCHOR = 32
PLACES = WINDOW - ANCHOR + 1
"""Where in a window its anchor may start."""

LARGEST_GROUP = 2000
"""Different fragments of an anchor that one task sorts; an anchor with more is split."""

PART_BYTES = 1 << 20
"""Bytes that are cut into fragments together; a longer text is cut in parts that overlap by a window, so memory does not grow with it."""

SORTED_BYTES = 1 << 20
"""Bytes whose suffixes are sorted together; small groups share a sort."""

BROADCAST_ROWS = 50_000
"""Hashes of so many counted keys at most are broadcast as they are; of more, a sieve of bits is."""

SIEVE_BITS = 1 << 25
"""Bits of a sieve, 4 MB for any number of keys; with more keys it lets more other rows through."""


def fragments_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, windows, place, anchor hash, content hash) of every fragment of the texts in ``data``.

    ``place`` is where in the first window the anchor starts.
    """
    n = len(data)
    if n < WINDOW:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    up, down = powers(n, PART_BYTES)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    grams = mix((total[ANCHOR:] - total[:-ANCHOR]) * down[: n - ANCHOR + 1])
    low = np.uint64((1 << 28) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(keys) // PLACES) * PLACES, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, PLACES)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - WINDOW + 1
    anchors = (np.minimum(behind[:count], ahead[PLACES - 1 : PLACES - 1 + count]) & low).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(count), "right") - 1
    whole = np.flatnonzero(np.arange(count) + WINDOW <= offsets[text + 1])
    if not len(whole):
        return fragments_of(data[:0], offsets[:1])
    anchors, text = anchors[whole], text[whole]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchors) != 0) | (np.diff(whole) != 1) | (np.diff(text) != 0)]))
    windows = np.diff(np.append(first, len(whole)))
    at, end = whole[first], whole[first] + windows + WINDOW - 1
    content = mix((total[end] - total[at]) * down[at] + (end - at).astype(np.uint64))
    return text[first], at - offsets[text[first]], windows, anchors[first] - at, grams[anchors[first]], content


def _fragments(texts: DataFrame) -> DataFrame:
    """(a, b, copies, start, windows, place, anchor, content) from (a, b, copies, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            about = [batch.column(i).to_numpy() for i in range(3)]
            for row, _, data, offsets in slices(batch.column(3), PART_BYTES):
                for before in range(0, max(1, len(data) - WINDOW + 1), PART_BYTES):
                    part = data[before : before + PART_BYTES + WINDOW - 1]
                    ends = offsets if len(offsets) > 2 else np.array([0, len(part)], np.int64)
                    text, start, windows, place, anchor, content = fragments_of(part, ends)
                    own = [c[row + text] for c in about]
                    columns = [*own, start + before, windows, place, anchor.view(np.int64), content.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "copies", "start", "windows", "place", "anchor", "content"])

    return texts.select("a", "b", "copies", "text").mapInArrow(cut, "a long, b long, copies long, start long, windows long, place long, anchor long, content long")


def _sieve(keys: DataFrame) -> DataFrame:
    """What ``_sifted`` broadcasts for the hashes ``key``; its size does not grow with their number."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return cut_lineage(keys.distinct())
    slot = F.pmod("key", F.lit(SIEVE_BITS)) + 1
    slots = keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("position")).repartition("bucket")
    return cut_lineage(slots.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")))


def _sifted(df: DataFrame, sieve: DataFrame, held: bool = True) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the sieve, with some others; or else the rest, whose keys are surely not in it."""
    if "key" in sieve.columns:
        return df.join(F.broadcast(sieve), "key", "left_semi" if held else "left_anti")
    slot = F.pmod("key", F.lit(SIEVE_BITS)) + 1
    joined = df.withColumn("bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(sieve), "bucket", "left")
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return joined.where(there if held else ~there).drop("bucket", "bits")


def _joined(docs: DataFrame, keyed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``keyed`` (a, b, doc_id, ...) with the text of the document that it names.

    Keys may be many and carry lists, so they are never broadcast; a sieve keeps most of the other texts out of the shuffle.
    """
    texts = docs.select(docs[doc_id].alias("at_id"), F.xxhash64(docs[text]).alias("at_hash"), docs[text].alias("text"))
    sieve = _sieve(keyed.select(F.xxhash64("doc_id", "a").alias("key")))
    texts = _sifted(texts.withColumn("key", F.xxhash64("at_id", "at_hash")), sieve).drop("key")
    return texts.join(keyed.hint("merge"), texts["at_id"].eqNullSafe(keyed["doc_id"]) & (texts["at_hash"] == keyed["a"]))


def _different(docs: DataFrame, texts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, b, copies, text) of ``texts``, each once; a text that surely has no copy is not moved."""
    sieve = _sieve(texts.where("copies > 1").select(F.col("a").alias("key")))
    own = docs.where(F.octet_length(docs[text]) >= WINDOW).select(F.xxhash64(docs[text]).alias("key"), F.xxhash64(docs[text], F.lit(1)).alias("b"), docs[text].alias("text"))
    alone = _sifted(own, sieve, held=False).select(F.col("key").alias("a"), "b", F.lit(1).cast("long").alias("copies"), "text")
    others = cut_lineage(_sifted(texts.withColumn("key", F.col("a")), sieve).select("a", "b", "doc_id", "copies"))
    return alone.unionAll(_joined(docs, others, doc_id, text).select("a", "b", "copies", "text"))


def _pieces(texts: DataFrame) -> DataFrame:
    """(anchor, content, place, windows, bytes) of the wanted fragments ``spots`` of each text."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spots in zip(batch.column(0), batch.column(1)):
                data = (text.as_py() or "").encode()
                rows += [(s["anchor"], s["content"], s["place"], s["windows"], data[s["start"] : s["start"] + s["windows"] + WINDOW - 1]) for s in spots.as_py()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], ["anchor", "content", "place", "windows", "bytes"])

    return texts.select("text", "spots").mapInArrow(take, "anchor long, content long, place long, windows long, bytes binary")


def _split(pool: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(groups of bounded size, repeats that splitting has shown); columns of ``pool``: id, group, low, high, skip, place, windows, bytes.

    ``low`` and ``high`` bound the place of the anchor in the windows of a group; ``skip`` counts the windows of the fragment before these.
    """
    small, shown = None, None
    while True:
        sizes = pool.groupBy("group").agg(F.count("*").alias("size")).where(F.col("size") > LARGEST_GROUP).select("group")
        if sizes.limit(1).count() == 0:
            return (pool if small is None else small.unionByName(pool)), shown
        sizes = cut_lineage(sizes)
        rest = pool.join(sizes, "group", "left_anti")
        small = rest if small is None else small.unionByName(rest)
        large = pool.join(sizes, "group").withColumn("middle", F.expr("(low + high) div 2"))
        before = F.least(F.greatest(F.col("place") - F.col("middle") + 1, F.lit(0)), F.col("windows"))
        halves = []
        for far in (True, False):
            taken = before if far else F.col("windows") - before
            skip = F.lit(0) if far else before
            low, high = (F.col("middle"), F.col("high")) if far else (F.col("low"), F.col("middle"))
            part = large.select("id", "group", low.alias("low"), high.alias("high"), (F.col("skip") + skip).alias("skip"), (F.col("place") - skip).alias("place"), taken.alias("windows"), F.substring("bytes", (skip + 1).cast("int"), (taken + WINDOW - 1).cast("int")).alias("bytes"))
            halves.append(part.where("windows > 0"))
        both = halves[0].unionAll(halves[1])
        common = F.substring("bytes", (F.col("place") - F.col("low") + 1).cast("int"), (F.col("low") + WINDOW - F.col("high") + 1).cast("int"))
        both = cut_lineage(both.withColumn("group", F.xxhash64("group", "low", "high", common)))
        alike = Window.partitionBy("group", "place", "windows", F.md5("bytes"))
        both = cut_lineage(both.withColumn("same", F.count("*").over(alike)).withColumn("rank", F.row_number().over(alike.orderBy("id.content"))))
        found = both.where("same > 1").select("id", F.col("skip").alias("from"), (F.col("skip") + F.col("windows") - 1).alias("to"))
        shown = found if shown is None else shown.unionAll(found)
        pool = cut_lineage(both.where("rank = 1").drop("same", "rank"))


def suffix_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for the window at each start, equal for equal windows and in the order of the suffixes to the depth of a window."""
    padded = np.concatenate([data, np.zeros(2 * WINDOW, np.uint8)]).astype(np.uint64)
    n = len(data) + WINDOW
    rank, depth = np.zeros(n, np.uint64), 0
    for depth in range(7):
        rank = rank << np.uint64(8) | padded[depth : depth + n]
    rank, depth = np.unique(rank, return_inverse=True)[1].astype(np.int64), 7
    while depth < WINDOW:
        step = min(depth, WINDOW - depth)
        ahead = np.concatenate([rank[step:], np.zeros(step, np.int64)])
        rank, depth = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1].astype(np.int64), depth + step
    return rank[starts]


def earlier_matches(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, next) smaller position in suffix order that shares a whole window with each position, or -1.

    Positions are 0, 1, ... in text order; suffix order is by class. Within a class, where common prefixes reach the depth, the
    neighbours that are smaller positions are found by following links until one is smaller.
    """
    order = np.argsort(classes, kind="stable")[::-1]
    same = classes[order[1:]] == classes[order[:-1]] if len(order) else np.zeros(0, bool)
    found = []
    for step in (-1, 1):
        linked = np.zeros(len(order), bool)
        if step == -1:
            linked[1:] = same
        else:
            linked[:-1] = same
        at = np.where(linked, np.arange(len(order)) + step, -1)
        while True:
            far = np.flatnonzero((at >= 0) & (order[np.maximum(at, 0)] >= order))
            if not len(far):
                break
            at[far] = at[at[far]]
        out = np.full(len(order), -1, np.int64)
        out[order] = np.where(at >= 0, order[np.maximum(at, 0)], -1)
        found.append(out)
    return found[0], found[1]


def repeated_windows(parts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Of each part, the runs (first, last) of windows that stand in the parts more than once."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    counts = np.array([len(p) - WINDOW + 1 for p in parts])
    owner = np.repeat(np.arange(len(parts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    classes = suffix_classes(data, np.repeat(ends - np.array([len(p) for p in parts]), counts) + inside)
    before, after = earlier_matches(classes)
    earlier = np.maximum(before, after)
    repeated = earlier >= 0
    repeated[np.unique(classes, return_index=True)[1][np.bincount(np.unique(classes, return_inverse=True)[1]) > 1]] = True
    at = np.flatnonzero(repeated)
    out: list[list[tuple[int, int]]] = [[] for _ in parts]
    if len(at):
        first = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0)]))
        last = np.append(first[1:], len(at)) - 1
        for i, j in zip(at[first], at[last]):
            out[owner[i]].append((int(inside[i]), int(inside[j])))
    return out


def _sorted(pool: DataFrame) -> DataFrame:
    """(id, from, to): runs of windows of a fragment that another fragment of its group has as well."""
    schema = f"id {pool.schema['id'].dataType.simpleString()}, from long, to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(rows: list[tuple]) -> pa.RecordBatch:
            found = [(r[1], r[2] + a, r[2] + b) for r, runs in zip(rows, repeated_windows([r[3] for r in rows])) for a, b in runs]
            columns = list(zip(*found)) or [[]] * 3
            kind = pa.struct([("anchor", pa.int64()), ("content", pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["id", "from", "to"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= SORTED_BYTES and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield settle(held)

    ordered = pool.select("group", "id", "skip", "bytes").repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(run, schema)


def _merged(found: list[dict]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start, end in sorted((f["start"], f["end"]) for f in found):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): different texts (a, b, doc_id, copies, n_bytes) and, of those that stand once, repeated ranges (a, b, found)."""
    named = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("a"), F.xxhash64(docs[text], F.lit(1)).alias("b"), F.octet_length(docs[text]).cast("long").alias("n_bytes"))
    texts = cut_lineage(named.where(F.col("n_bytes") >= WINDOW).groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes")))
    cut = _fragments(_different(docs, texts, doc_id, text))
    anchor = Window.partitionBy("anchor")
    known = cut.withColumn("low", F.min("content").over(anchor)).withColumn("high", F.max("content").over(anchor)).withColumn("known", F.sum("copies").over(anchor))
    known = cut_lineage(known.where("known > 1").withColumn("mixed", F.col("low") != F.col("high")).drop("low", "high", "known"))
    equal = known.groupBy("anchor", "content").agg(F.sum("copies").alias("times"), F.max("mixed").alias("mixed"), F.min(F.struct("a", "b", "start", "windows", "place")).alias("spot"))
    equal = cut_lineage(equal)

    spots = equal.where("mixed").groupBy("spot.a", "spot.b").agg(F.collect_list(F.struct("anchor", "content", "spot.start", "spot.windows", "spot.place")).alias("spots"))
    wanted = cut_lineage(spots.join(texts.select("a", "b", "doc_id"), ["a", "b"]))
    pool = _pieces(_joined(docs, wanted, doc_id, text)).dropDuplicates(["anchor", "content"])
    pool = pool.select(F.struct("anchor", "content").alias("id"), F.col("anchor").alias("group"), F.lit(0).alias("low"), F.lit(PLACES).alias("high"), F.lit(0).cast("long").alias("skip"), "place", "windows", "bytes")
    groups, shown = _split(cut_lineage(pool))
    part = _sorted(groups)
    part = part if shown is None else part.unionAll(shown)

    once = known.join(texts.where("copies = 1").select("a", "b"), ["a", "b"], "left_semi")
    whole = once.join(equal.where("times > 1").select("anchor", "content"), ["anchor", "content"]).select("a", "b", "start", (F.col("start") + F.col("windows") + WINDOW - 1).alias("end"))
    some = part.select("id.anchor", "id.content", "from", "to").join(equal.where("times = 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    some = once.join(some, ["anchor", "content"]).select("a", "b", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to") + WINDOW).alias("end"))
    return texts, whole.unionAll(some).groupBy("a", "b").agg(F.collect_list(F.struct("start", "end")).alias("found"))


@_cleaning
def removed_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 after every byte in a repeated string of ``WINDOW`` bytes is removed.

    A null text is empty. Repeated rows are documents that repeat each other; null ids are documents like any other.
    """
    texts, spans = repeated_spans(docs, doc_id, text)
    wanted = cut_lineage(spans.join(texts.select("a", "b", "doc_id"), ["a", "b"]))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, number, sha = [], [], []
            for value, found in zip(batch.column(2), batch.column(3)):
                data, kept, at = (value.as_py() or "").encode(), hashlib.sha256(), 0
                merged = _merged(found.as_py())
                for start, end in merged:
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                removed.append(sum(e - s for s, e in merged))
                number.append(len(merged))
                sha.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(sha, pa.string())], ["a", "b", "n_removed", "n_spans", "sha"])

    cut = _joined(docs, wanted, doc_id, text).select("a", "b", "text", "found").mapInArrow(digest, "a long, b long, n_removed long, n_spans long, sha string")
    copied = texts.where("copies > 1").select("a", "b", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("sha"))
    known = cut_lineage(cut.unionAll(copied))
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("a"), F.xxhash64(docs[text], F.lit(1)).alias("b"), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("own"))
    joined = rows.join(known, ["a", "b"], "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))
