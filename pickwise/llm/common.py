"""Helpers shared by the text operators: tables, batches, words and 64-bit hashes."""

from __future__ import annotations

import math
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# functions run on executors travel with the job, not through the executors' import path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def worker_held(name: str) -> dict:
    """A dictionary that lasts as long as the worker process. Functions that travel with the job get new
    globals in every task, so what one of them keeps there is built anew and left to the garbage collector."""
    return sys.modules.setdefault(f"_pickwise_{name}", ModuleType(name)).__dict__


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null becomes the empty text."""
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of the given columns (lists or numpy arrays)."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema
    )


def task_count(spark: SparkSession, units: int, per_task: int) -> int:
    """Partitions so that one holds about ``per_task`` units; never below the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(units / per_task))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words (public murmur3 finaliser constants)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a text.

    ``bytes.lower`` changes A-Z alone and ``bytes.split`` cuts at ``[\\x20\\x09-\\x0D]+``.
    A text of fewer words gives its whole word sequence as one shingle, one without words none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    w = word_hashes(words)
    m = len(w) - n + 1
    h = w[:m].copy()
    for i in range(1, n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:m + i]
    return np.unique(mix64(h))


class TwoGenerations(dict):
    """A cache of ``make``'s results that takes at most about ``limit`` bytes: when the young generation
    holds half of them it becomes the old one, and what is still used comes back from there, so nothing
    is lost at once. Keys of more than ``longest`` characters are not kept."""

    ENTRY = 100  # bytes of a slot in a dictionary that may be part empty

    def __init__(self, make, limit: int, longest: int):
        self.make, self.limit, self.longest = make, limit // 2, longest
        self.used, self.old = 0, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= self.longest:
            if self.used >= self.limit:
                self.old, self.used = dict(self), 0
                self.clear()
            self.used += self.ENTRY + sys.getsizeof(key) + sys.getsizeof(got)
            self[key] = got
        return got
