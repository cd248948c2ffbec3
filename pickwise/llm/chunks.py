"""Byte-level BPE encoding word by word, with a cache of bounded size around the tokenizers library.

The library first splits a text into words by a pattern. For plain texts that pattern is plain too, so
words are found here, encoded by the library once and then looked up (texts of ASCII and common
Latin characters). In other texts a single
space between two characters that are no white space always begins a new word, and a single line
break between two such characters is a word of its own: the text is cut there, and its pieces are
encoded by the library once and then looked up.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
from pyspark import cloudpickle

from pickwise.llm.common import TwoGenerations

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# a cut is certain only between characters that no reading of \s counts as white space
_SPACE = re.compile(r"(?<=\S) (?=\S)")
_BREAK = re.compile(r"(?<=\S)(\n)(?=\S)")


class _Unsafe(Exception):
    pass


# The public pattern of byte-level BPE for plain texts: white space and numbers are ASCII, letters are
# ASCII or of Latin-1 and Latin Extended-A (all of these two ranges but the two signs), other
# characters are ASCII or common punctuation.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_WORDS = re.compile(
    rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^ \t-\r0-9{_LETTERS}]+| ?[0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
_OTHER = re.compile(rf"[^\x00-\x7f{_LETTERS}¡¿«»–—‘’“”…]")
# byte-level BPE's printable stand-ins for bytes: printable Latin-1 stands for itself, the rest follows from 256 on
_SELF = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SELF)}


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library (no special tokens are added, and their strings in
    a text are ordinary text). The caches take at most ``cache_bytes``, estimated."""

    _made: dict[int, "ChunkEncoder"] = {}

    def __init__(self, tokenizer_json: str, cache_bytes: int = 256 << 20, longest: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.words = TwoGenerations(self._word, cache_bytes * 8 // 10, longest)
        self.spaced = TwoGenerations(self._spaced, cache_bytes // 10, longest)
        self.bare = TwoGenerations(self._bare, cache_bytes // 10, longest)
        self.newline = self.library("\n")

    @classmethod
    def of(cls, tokenizer_json: str) -> "ChunkEncoder":
        """One encoder per worker process and tokenizer."""
        key = hash(tokenizer_json)
        if key not in cls._made:
            cls._made[key] = cls(tokenizer_json)
        return cls._made[key]

    def library(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """One word of the pattern: the library's merges alone."""
        plain = word.isascii() and word.isprintable()
        stand_in = word.replace(" ", "Ġ") if plain else word.encode().decode("latin-1").translate(_BYTES)
        return array(self.code, [t.id for t in self.model.tokenize(stand_in)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self.library(piece) if _OTHER.search(piece) else b"".join(map(self.words.__getitem__, _WORDS.findall(piece)))

    def _spaced(self, piece: str) -> bytes:
        return self._piece(" " + self._solid(piece))

    def _bare(self, piece: str) -> bytes:
        return self._piece(self._solid(piece))

    def _solid(self, piece: str) -> str:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Unsafe
        return piece

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if not text:
            return np.empty(0, self.dtype)
        if not _OTHER.search(text):
            found = map(self.words.__getitem__, _WORDS.findall(text))
        else:
            try:
                found = self._lines(text)
            except _Unsafe:
                found = self._certain(text)
        return np.frombuffer(b"".join(found), self.dtype)

    def _lines(self, text: str) -> list[bytes]:
        found = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            found.append(self.bare[first])
            found += map(self.spaced.__getitem__, rest)
            found.append(self.newline)
        found.pop()
        return found

    def _certain(self, text: str) -> list[bytes]:
        """A text with other white space, cut only where a cut is certain."""
        found = []
        for at, part in enumerate(_SPACE.split(text)):
            for i, x in enumerate(_BREAK.split(part)):
                found.append(self._piece(" " + x if at and not i else x))
        return found
