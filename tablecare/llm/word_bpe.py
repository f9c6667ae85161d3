"""Token ids of many texts under a BPE vocabulary with word ends, a word at a time.

Words repeat, so each is encoded once per task. Plain words go through a rank-based encoder over the same vocabulary, with a byte that
UTF-8 never uses as the word end; whatever its rules may not cover (letters beyond Latin, control characters, special tokens)
goes through the tokenizer itself.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from functools import lru_cache

import regex
import tiktoken
from tokenizers import Tokenizer

MOST_WORDS = 400_000
"""Words that a task remembers; then it starts anew. This bounds memory and changes no id."""

_PLAIN = regex.compile("[\\x21-\\x7e\\xa1-\\u024f]+")
_SEPARATORS = regex.compile("[\\x1c-\\x1f]")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_END = b"\xff"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself if printable, else shifted above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds(dict):
    """Word -> its token ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str):
        super().__init__()
        model = json.loads(vocabulary)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = tuple(t["content"] for t in model["added_tokens"])
        letters, end = _byte_letters(), model["model"]["end_of_word_suffix"]
        ranks = {}
        for token, rank in model["model"]["vocab"].items():
            if token not in self.special:
                body = bytes(letters[c] for c in token.removesuffix(end))
                ranks.setdefault(body + _END if token.endswith(end) else body, rank)
        ranks[_END] = ranks.pop(_END, letters["ÿ"])
        self.ranked = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and not any(s in word for s in self.special):
            pieces = _PIECES.findall(unicodedata.normalize("NFC", word).lower())
            ids = [i for p in pieces for i in self.ranked.encode_single_piece(p.encode() + _END)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        if len(self) >= MOST_WORDS:
            self.clear()
        packed = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        if _SEPARATORS.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=1)
def word_ids(vocabulary: str) -> WordIds:
    """The encoder of a vocabulary, once per Python worker."""
    return WordIds(vocabulary)
