"""Quality rules with cutoffs that are controlled for risk.

Measures of a text (symbols, repeats, word shapes) are compared with cutoffs. A cutoff is taken only if labelled documents prove,
with an exact binomial bound, that it rejects few good ones: per stratum, with the error split over all strata and rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablecare.llm.words import Words, mix, slices, spans_hash, windows

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_short_words"]

WINDOW = 8
"""Words in a window of which two equal ones count as repeated."""

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def measure_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each text of a slice."""
    words = Words(data, offsets)
    owner, first, starts = words.owner, words.first, words.starts
    texts = len(offsets) - 1

    def per_text(marks: np.ndarray) -> np.ndarray:
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    out = {"n_words": np.diff(first), "word_chars": per_text(((data & 0xC0) != 0x80) & ~words.space), "n_symbols": per_text(_SYMBOL[data])}

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))[: len(line_start)]
    line_end = line_end - (data[line_end - 1] == 10)
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    keys = mix(spans_hash(data, line_start, line_end) + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, firsts = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(line_text, minlength=texts) - np.bincount(line_text[firsts], minlength=texts)

    repeated = np.zeros(len(starts) + 1, np.int64)
    runs = windows(words.hashes(), WINDOW)
    if len(runs):
        whole = np.flatnonzero(owner[: len(runs)] == owner[WINDOW - 1 :])
        keys = mix(runs[whole] + owner[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(whole), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(repeated, whole[twice], 1)
        np.add.at(repeated, whole[twice] + WINDOW, -1)
    covered = np.cumsum(repeated)[:-1] > 0
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=texts)
    out["n_capitals"] = per_text((data >= 65) & (data <= 90))
    lengths = words._edges[1] - starts
    out["n_short_words"] = np.bincount(owner[lengths <= 3], minlength=texts)
    return out


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as a struct ``row`` (all its columns, or those of ``keep``) beside the measures of its text, without a shuffle.

    A null text counts as empty; all its measures are 0. Columns pass through inside ``row``, so their names cannot clash.
    """
    columns = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), *([] if text in columns else [docs[text].alias("text")]))
    inside = columns.index(text) if text in columns else None
    schema = T.StructType([packed.schema["row"], *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            for a, b, data, offsets in slices(batch.column(1) if inside is None else rows.flatten()[inside]):
                found = measure_texts(data, offsets)
                yield pa.RecordBatch.from_arrays([rows.slice(a, b - a), *[pa.array(found[m], pa.int64()) for m in MEASURES]], ["row", *MEASURES])

    return packed.mapInArrow(run, schema)


def base_failed() -> Column:
    """The fixed rules: under 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


RULES = {
    "symbols": (lambda: _share("n_symbols", "n_words"), [1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05]),
    "capitals": (lambda: _share("n_capitals", "word_chars"), [0.9, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1]),
    "repeats": (lambda: _share("n_repeat_words", "n_words"), [0.3, 0.2, 0.15, 0.1, 0.05]),
    "dup_lines": (lambda: _share("n_dup_lines", "n_words"), [0.2, 0.1, 0.05, 0.02]),
}
"""Rule name: the share that it looks at and its cutoffs from lax to strict. Fixed beforehand, so that labels only choose among them."""


@dataclass(frozen=True)
class Cutoff:
    """A chosen cutoff: in ``stratum``, ``rule`` rejects shares above ``above``; its false rejection is at most ``bound``."""

    stratum: str | None
    rule: str
    above: float
    bound: float
    good: int
    good_rejected: int
    bad_rejected: int


def binomial_upper(hits: int, trials: int, error: float) -> float:
    """The exact (Clopper-Pearson) upper bound of a rate: where as few as ``hits`` of ``trials`` has probability ``error``."""
    if hits >= trials:
        return 1.0
    ways = [math.lgamma(trials + 1) - math.lgamma(i + 1) - math.lgamma(trials - i + 1) for i in range(hits + 1)]

    def at_most(rate: float) -> float:
        return sum(math.exp(w + i * math.log(rate) + (trials - i) * math.log1p(-rate)) for i, w in enumerate(ways))

    low, high = hits / trials, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(middle) > error else (low, middle)
    return high


def fit_cutoffs(labelled: DataFrame, stratum: str, quality: str = "quality", risk: float = 0.04, error: float = 0.05) -> list[Cutoff]:
    """Choose cutoffs from labelled measures (:func:`measure` columns, ``stratum``, 1 good / 0 bad).

    With probability ``1 - error`` no stratum loses more than ``risk`` of its good documents. ``risk`` and ``error`` are split
    evenly over the rules, and ``error`` over the strata as well (Bonferroni). Within a rule cutoffs are tested from lax to strict
    and the first that fails ends the test, so that needs no further correction. Of the passed ones the laxest that rejects
    most bad documents is taken, none if it rejects no more bad than good ones. Counts are one aggregate over all labelled rows;
    the driver gets a row per stratum. A null stratum is a stratum; rows without a label are left out; without rows, no cutoff.
    """
    good, bad = F.col(quality) == 1, F.col(quality) == 0
    counts = [F.count_if(good).alias("good"), F.count_if(bad).alias("bad")]
    for rule, (share, cutoffs) in RULES.items():
        for i, cutoff in enumerate(cutoffs):
            counts += [F.count_if(good & (share() > cutoff)).alias(f"{rule}_{i}_good"), F.count_if(bad & (share() > cutoff)).alias(f"{rule}_{i}_bad")]
    strata = labelled.where(F.col(quality).isin(0, 1) & ~base_failed()).groupBy(F.col(stratum).alias("stratum")).agg(*counts).collect()
    chosen = []
    for row in sorted(strata, key=lambda r: str(r["stratum"])):
        for rule, (_, cutoffs) in RULES.items():
            best = None
            for i, cutoff in enumerate(cutoffs):
                lost, caught = row[f"{rule}_{i}_good"], row[f"{rule}_{i}_bad"]
                if lost > row["good"] * risk / len(RULES):
                    break
                bound = binomial_upper(lost, row["good"], error / (len(strata) * len(RULES)))
                if bound > risk / len(RULES):
                    break
                if caught > lost and (best is None or caught > best.bad_rejected):
                    best = Cutoff(row["stratum"], rule, cutoff, bound, row["good"], lost, caught)
            chosen += [best] if best else []
    return chosen


def verdict(cutoffs: list[Cutoff], stratum: Column) -> Column:
    """Whether a measured row passes the fixed rules and all cutoffs of its stratum."""
    rejected = [stratum.eqNullSafe(F.lit(c.stratum)) & (RULES[c.rule][0]() > F.lit(c.above)) for c in cutoffs]
    return ~reduce(Column.__or__, rejected, base_failed())


def fit_on(measured: DataFrame, labels: DataFrame, stratum: str = "lang") -> list[Cutoff]:
    """Cutoffs from the measured documents (doc_id, ``stratum``, measures) that ``labels`` (doc_id, quality) covers.

    An id that occurs more often counts each time. Only measures meet the labels in the join, never texts.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").alias("quality"))
    return fit_cutoffs(measured.select("doc_id", F.col(stratum).alias("stratum"), *MEASURES).join(known, "doc_id"), "stratum")
