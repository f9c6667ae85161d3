"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at each step. The last letter of a word and its end are one symbol, so a piece
inside a word never takes the last letter, and a byte-level vocabulary with both forms of every byte covers every word. The automaton is the trie of the vocabulary with, for every
node, the node to go on from when the next letter does not fit and the number of pieces that are finished by then. So a word
is read once, letter by letter, and its pieces are counted without being built.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

END = "</w>"
"""Ends the last piece of a word in the vocabulary."""

MOST_WORDS = 400_000
"""Words whose counts a task remembers; then it starts anew. This bounds memory and changes no count."""


class LongestMatch:
    """The automaton of a vocabulary over letters and a word end.

    ``follow`` maps (node, symbol) to a node, ``back`` a node to the node that reads on after its pieces are taken off, ``popped`` to how
    many that are. A node without a piece to take off goes back to -1: there greedy matching fails and the word is unknown.
    """

    def __init__(self, vocabulary: Iterable[str]):
        self.follow: list[dict[str, int]] = [{}]
        self.back, self.popped, whole = [-1], [0], [False]
        for entry in sorted(set(vocabulary)):
            node = 0
            for symbol in self.symbols(entry):
                if symbol not in self.follow[node]:
                    self.follow[node][symbol] = len(self.follow)
                    self.follow.append({})
                    self.back.append(-1)
                    self.popped.append(0)
                    whole.append(False)
                node = self.follow[node][symbol]
            whole[node] = node > 0
        waiting = deque([0])
        while waiting:
            parent = waiting.popleft()
            for symbol, node in self.follow[parent].items():
                if whole[node]:
                    self.back[node], self.popped[node] = 0, 1
                else:
                    at, taken = self.back[parent], self.popped[parent]
                    while at >= 0 and symbol not in self.follow[at]:
                        at, taken = self.back[at], taken + self.popped[at]
                    if at >= 0:
                        self.back[node], self.popped[node] = self.follow[at][symbol], taken
                waiting.append(node)

    @staticmethod
    def symbols(entry: str) -> list[str]:
        return [*entry.removesuffix(END), END] if entry.endswith(END) else list(entry)

    @classmethod
    def ended(cls, word: str) -> list[str]:
        """The symbols of a whole word."""
        return cls.symbols(word + END)

    def count(self, word: str) -> int:
        """Pieces of a word, or 1 for the unknown token if greedy matching cannot cover it."""
        node, pieces = 0, 0
        for symbol in self.ended(word):
            while symbol not in self.follow[node]:
                if self.back[node] < 0:
                    return 1
                pieces += self.popped[node]
                node = self.back[node]
            node = self.follow[node][symbol]
        while node:
            if self.back[node] < 0:
                return 1
            pieces += self.popped[node]
            node = self.back[node]
        return pieces


class EndedMatch(LongestMatch):
    """The automaton over letters of which the last one of a word carries the word end: ``r`` and ``r</w>`` are two symbols."""

    @staticmethod
    def symbols(entry: str) -> list[str]:
        body = entry.removesuffix(END)
        return [*body[:-1], body[-1:] + END] if entry.endswith(END) else list(entry)


class Counts(dict):
    """Word -> number of pieces."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = self.automaton.count("".join(map(byte_letter, word.encode())))
        return found


_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]


def byte_letter(byte: int) -> str:
    """The letter of a byte-level vocabulary for a byte: itself if printable, else shifted above 255."""
    return chr(byte) if byte in _SHOWN else chr(256 + _HIDDEN.index(byte))


@lru_cache(maxsize=1)
def _counts(vocabulary: str) -> Counts:
    model = json.loads(vocabulary)
    special = {t["content"] for t in model["added_tokens"]}
    return Counts(EndedMatch(t for t in model["model"]["vocab"] if t not in special))


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words (between white space, in lower case) and n_tokens, its greedy word pieces.

    ``vocabulary`` is the JSON text of a byte-level tokenizer with word ends. A null or blank text has no words. Repeated rows and null
    ids are documents like any other; further columns do not matter. A word may be as long as the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(shared.value)
        for batch in batches:
            words = [(value.as_py() or "").lower().split() for value in batch.column(1)]
            tokens = [sum(map(counts.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
