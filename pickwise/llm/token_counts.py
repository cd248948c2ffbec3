"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary (word-initial pieces and continuation pieces) becomes a trie with two roots.
Every node has a failure link and the number of pieces popped when it is followed: a node
that is a piece fails to the continuation root and pops itself; any other node fails where
its parent's failure chain can take the same character, and pops what that chain popped.
Reading a word then follows one edge a character, adds the popped counts, and never builds
a piece or looks back. Words of a worker are cached (bounded).
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import TwoGenerations, batch, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEAD = -1


class PieceCounter:
    """Greedy longest-match counts of a vocabulary of initial and continuation pieces."""

    def __init__(self, initial: Iterable[str], continuation: Iterable[str], max_chars: int = 200):
        self.max_chars = max_chars
        self.step: list[dict[str, int]] = [{}, {}]  # node 0: word start, node 1: continuation
        self.depth = [0, 0]
        self.piece = [False, False]
        for root, words in ((0, initial), (1, continuation)):
            for w in words:
                if w:
                    self._add(root, w)
        self._link()

    def _add(self, at: int, word: str) -> None:
        for c in word:
            nxt = self.step[at].get(c)
            if nxt is None:
                nxt = self.step[at][c] = len(self.step)
                self.step.append({})
                self.depth.append(self.depth[at] + 1)
                self.piece.append(False)
            at = nxt
        self.piece[at] = True

    def _link(self) -> None:
        step, n = self.step, len(self.step)
        self.fail, self.pops = [DEAD] * n, [0] * n
        todo = deque([0, 1])
        while todo:
            at = todo.popleft()
            for c, nxt in step[at].items():
                if self.piece[nxt]:
                    self.fail[nxt], self.pops[nxt] = 1, 1
                else:
                    f, popped = self.fail[at], self.pops[at]
                    while f != DEAD and c not in step[f]:
                        popped += self.pops[f]
                        f = self.fail[f]
                    if f != DEAD:
                        self.fail[nxt], self.pops[nxt] = step[f][c], popped
                todo.append(nxt)

    def count(self, word: str) -> int:
        """Pieces of one word; 1 (the unknown piece) if it can't be cut whole or is too long."""
        if not word:
            return 0
        if self.max_chars is not None and len(word) > self.max_chars:
            return 1
        step, fail, pops = self.step, self.fail, self.pops
        at, total = 0, 0
        for c in word:
            nxt = step[at].get(c)
            while nxt is None:
                total += pops[at]
                at = fail[at]
                if at == DEAD:
                    return 1
                nxt = step[at].get(c)
            at = nxt
        while at != 1:  # pop what the last node still holds
            total += pops[at]
            at = fail[at]
            if at == DEAD:
                return 1
        return total


def split_vocabulary(pieces: Iterable[str], mark: str = "▁") -> tuple[list[str], list[str]]:
    """(initial, continuation) pieces of a vocabulary that marks word starts with ``mark``."""
    first, rest = [], []
    for p in pieces:
        (first if p.startswith(mark) else rest).append(p.removeprefix(mark))
    return [p for p in first if p], [p for p in rest if p]


CACHE_BYTES = 64 << 20
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(
    docs: DataFrame, initial: list[str], continuation: list[str], max_chars: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` for every row. Words are runs without ``[\\x20\\x09-\\x0D]``.

    Null and empty texts have no words. A word that the vocabulary can't cut whole, or of over
    ``max_chars`` characters if that is set, is one unknown token. Repeated rows are counted each; other columns
    are ignored. The vocabulary is broadcast; its size does not depend on the data."""
    pieces = docs.sparkSession.sparkContext.broadcast((tuple(initial), tuple(continuation), max_chars))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))

    def run(batches):
        counter = PieceCounter(*pieces.value)
        counts = TwoGenerations(lambda word: counter.count(word.decode(errors="replace")), CACHE_BYTES, 64)
        for b in batches:
            words = [t.split() for t in b.column(1).to_pylist()]
            yield batch(OUT, b.column(0), [len(w) for w in words], [sum(map(counts.__getitem__, w)) for w in words])

    return src.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
