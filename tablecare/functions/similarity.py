"""Word similarity: the best trigram overlap of a term with any run of a text's trigrams."""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The functions travel to the workers by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: a word is a run of letters and digits.
WORD = re.compile(r"[^\W_]+")


def word_trigrams(text: str) -> list[str]:
    """The trigrams of each word in order; a word has two blanks before it and one after."""
    grams: list[str] = []
    for word in WORD.findall(text.lower()):
        padded = f"  {word} "
        grams.extend(padded[i : i + 3] for i in range(len(padded) - 2))
    return grams


def best_overlap(wanted: frozenset[str], run: list[str]) -> float:
    """Largest |A & E| / |A | E| over the contiguous runs E of ``run``, A being ``wanted``.

    Only runs that start and end on a wanted trigram can be best. A run is dropped as soon
    as its extra trigrams alone keep it from beating the best so far.
    """
    best = 0.0
    size = len(wanted)
    for start, first in enumerate(run):
        if first not in wanted:
            continue
        hits: set[str] = set()
        extra: set[str] = set()
        for gram in run[start:]:
            if gram in wanted:
                hits.add(gram)
                best = max(best, len(hits) / (size + len(extra)))
                if len(hits) == size:
                    break
            else:
                extra.add(gram)
                if size / (size + len(extra)) <= best:
                    break
        if best == 1.0:
            break
    return best


def _scores(terms: list[str | None], texts: list[str | None]) -> list[float]:
    """The score of each pair; equal pairs are scored once, and texts and terms are cut once."""
    cut: dict[str, list[str]] = {}
    scored: dict[tuple[str | None, str | None], float] = {}
    for pair in zip(terms, texts):
        if pair in scored:
            continue
        term, text = pair
        if not term or not text:
            scored[pair] = 0.0
            continue
        for part in pair:
            if part not in cut:
                cut[part] = word_trigrams(part)
        scored[pair] = best_overlap(frozenset(cut[term]), cut[text]) if cut[term] else 0.0
    return [scored[pair] for pair in zip(terms, texts)]


@F.pandas_udf(T.DoubleType())
def _word_similarity(terms: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series(_scores(terms.tolist(), texts.tolist()), dtype="float64")


def word_similarity(term: Column, text: Column) -> Column:
    """How well ``term`` matches some stretch of ``text``, from 0 to 1 (NULL counts as empty)."""
    return _word_similarity(term, text)


def plain_words(text: Column) -> Column:
    """The words of a text in lower case with one blank between them; NULL counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def padded_words(words: Column) -> Column:
    """:func:`plain_words` with two blanks before and one after each word, so that every trigram of a word is a substring of it."""
    return F.when(words == "", "").otherwise(F.concat(F.lit("  "), F.replace(words, F.lit(" "), F.lit("   ")), F.lit(" ")))


FORMS = ((0, 0), (0, 1), (2, 0), (2, 1))
"""Letters that a form of a padded term lacks at its start and its end; so many trigrams it lacks there."""


def term_facts(words: Column) -> Column:
    """What bounds need of a term's :func:`plain_words`: words, wanted, and a text and a score of each form.

    ``wanted`` are its distinct trigrams. A form is a substring of a padded text that proves a score: the whole term, the term without
    its end, without its start, without both.
    """
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, 3))
    run = F.when(words == "", F.array().cast("array<string>")).otherwise(F.flatten(F.transform(F.split(words, " "), cut)))
    padded, size, wanted = padded_words(words), F.size(run), F.array_distinct(run)

    def form(skip: int, drop: int) -> list[Column]:
        part = F.slice(run, skip + 1, F.greatest(size - skip - drop, F.lit(0)))
        proof = F.substring(padded, F.lit(skip + 1), F.length(padded) - skip - drop)
        score = F.size(F.array_distinct(part)) / F.greatest(F.size(wanted), F.lit(1))
        return [proof.alias(f"form_{skip}{drop}"), F.when(proof == "", 0.0).otherwise(score).alias(f"score_{skip}{drop}")]

    return F.struct(words.alias("words"), wanted.alias("wanted"), *[c for skip, drop in FORMS for c in form(skip, drop)])


def similarity_bounds(facts: Column, padded: Column) -> tuple[Column, Column]:
    """(at least, at most) the word similarity of a term and a text with these :func:`padded_words`, without looking at its runs.

    A run that is a form of the term has no other trigram, so its share of the term's trigrams is reached; and no run can share more
    trigrams than the text does. Mostly the two are equal, and then they are the score.
    """
    proven = [F.when(F.contains(padded, facts[f"form_{s}{d}"]), facts[f"score_{s}{d}"]).otherwise(F.lit(0.0)) for s, d in FORMS]
    shared = F.size(F.filter(facts["wanted"], lambda g: F.contains(padded, g)))
    return F.greatest(*proven), shared / F.greatest(F.size(facts["wanted"]), F.lit(1))
