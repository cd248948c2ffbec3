"""Hashed word n-gram features of whole texts."""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark import cloudpickle

from pickwise.llm.common import mix64, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# words, and runs of signs between them; white space cuts
TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\x00-\x200-9A-Za-z_\x80-\xff]+")
WORD = re.compile(rb"[0-9a-z_\x80-\xff]+")


def ngram_counts(text: bytes, bits: int, n: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashed ids, counts) of the 1- to ``n``-grams of words and sign runs."""
    w = word_hashes(TOKEN.findall(text))
    if not len(w):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams, h = [w], w
    for k in range(1, min(n, len(w))):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[k:]
        grams.append(h)
    return np.unique((mix64(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)


def word_ids(text: bytes, bits: int) -> np.ndarray:
    """Sorted distinct hashed ids of the words, A-Z lowered, and of their first six bytes (inflected
    forms of one stem share them)."""
    w = set(WORD.findall(text.lower()))
    w |= {b"^" + x[:6] for x in w if len(x) > 6}
    return np.unique(mix64(word_hashes(list(w))) >> np.uint64(64 - bits)).astype(np.int64)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))
