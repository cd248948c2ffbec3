"""Line deduplication over a sharded minimal perfect hash of the distinct lines.

1. Every task digests its documents' lines (128 bits of the line's key) and combines equal
   digests of a batch, so a line that fills the corpus leaves a task once a batch.
2. Digests are dealt to shards of about ``shard_keys`` lines. A shard's task sorts out the
   distinct digests and builds a minimal perfect hash over them: levels of bit arrays, where
   a digest that is alone on its bit stays and the others go to the next level; its slot is
   the rank of its bit. The slot indexes three arrays: a 32-bit fingerprint, a saturating
   count of documents, and the smallest document that holds the line.
3. Documents probe: their digests go to the shard's arrays, and only hits (a line held by
   two documents, in a document that is not the first) come back. Lines themselves are
   never joined. A line in so many documents that its probes would crowd one shard is
   found at build time; the number of such lines is bounded (see ``heavy_floor``), so they are
   broadcast and answered where the document is.
4. A document drops the hit lines and joins what is left.

Every probe is of a line that is in the index, so an answer is wrong only if two lines share
all 128 bits of their digest.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import batch, mix64, text_bytes
from pickwise.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_CHARS = 10
SHARD_KEYS = 50_000
NO_ID = (1 << 63) - 1  # a null id counts as one document after all others

SEEN = pa.schema([("shard", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64())])
PROBE = pa.schema([("shard", pa.int64()), ("doc", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
INDEX = (
    "shard long, n_keys long, level_bits array<long>, bits binary, spare binary, fingerprints binary, "
    "counts binary, firsts binary, heavy binary"
)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without white space at its ends and with A-Z lowered; None if it is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode(errors="replace")) < min_chars:
        return None
    return key


def doc_digests(text: bytes, min_chars: int) -> set[bytes]:
    keys = (line_key(x, min_chars) for x in text.split(b"\n"))
    return {xxhash.xxh3_128_digest(k) for k in keys if k is not None}


# --- minimal perfect hash ---------------------------------------------------------------
LEVELS, SPACE = 24, 2


def _spot(h1: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mix64(h1 ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bits)


def build_mph(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """(bits per level, all bits, keys left over, slot of every key) for distinct (h1, h2)."""
    slot = np.full(len(h1), -1, np.int64)
    left, sizes, marks, used = np.arange(len(h1)), [], [], 0
    seed = h1 ^ mix64(h2)
    for level in range(LEVELS):
        if not len(left):
            break
        m = max(64, SPACE * len(left))
        at = _spot(seed[left], level, m).astype(np.int64)
        alone = np.bincount(at, minlength=m) == 1
        ok = alone[at]
        rank = np.cumsum(alone) - 1
        slot[left[ok]] = used + rank[at[ok]]
        used += int(ok.sum())
        sizes.append(m)
        marks.append(alone)
        left = left[~ok]
    order = np.argsort(seed[left])
    left = left[order]
    slot[left] = used + np.arange(len(left))
    return sizes, np.concatenate(marks) if marks else np.zeros(0, bool), seed[left], slot


class LineIndex:
    """One shard's arrays, ready for probing."""

    def __init__(self, row: dict):
        self.n = int(row["n_keys"])
        self.sizes = [int(x) for x in row["level_bits"]]
        total = sum(self.sizes)
        self.bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=total).astype(bool)
        self.rank = np.cumsum(self.bits) - 1
        self.spare = np.frombuffer(row["spare"], np.uint64)
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint32)
        self.counts = np.frombuffer(row["counts"], np.uint8)
        self.firsts = np.frombuffer(row["firsts"], np.int64)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for a key whose fingerprint is not the slot's."""
        seed = h1 ^ mix64(h2)
        out = np.full(len(seed), -1, np.int64)
        left, base = np.arange(len(seed)), 0
        for level, m in enumerate(self.sizes):
            at = base + _spot(seed[left], level, m).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + m
        if len(left) and len(self.spare):
            at = np.minimum(np.searchsorted(self.spare, seed[left]), len(self.spare) - 1)
            hit = self.spare[at] == seed[left]
            out[left[hit]] = self.n - len(self.spare) + at[hit]
        known = out >= 0
        known[known] = self.fingerprints[out[known]] == _fingerprint(h2[known])
        out[~known] = -1
        return out


def _fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2 >> np.uint64(32)).astype(np.uint32)


def _build_shard(pdf: pd.DataFrame, heavy_from: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["h1", "h2"], ignore_index=True)
    h1, h2 = pdf.h1.to_numpy(np.int64), pdf.h2.to_numpy(np.int64)
    start = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    first = np.minimum.reduceat(pdf["first"].to_numpy(), start)
    last = np.maximum.reduceat(pdf["last"].to_numpy(), start)
    n = np.add.reduceat(pdf["n"].to_numpy(), start)
    n[first == last] = 1  # rows that repeat one document id are one document
    u1, u2 = h1[start].view(np.uint64), h2[start].view(np.uint64)
    sizes, bits, spare, slot = build_mph(u1, u2)
    fingerprints, counts, firsts = np.empty(len(slot), np.uint32), np.empty(len(slot), np.uint8), np.empty(len(slot), np.int64)
    fingerprints[slot], counts[slot], firsts[slot] = _fingerprint(u2), np.minimum(n, 255), first
    hot = n >= heavy_from
    heavy = np.stack([u1[hot].view(np.int64), u2[hot].view(np.int64), first[hot]], axis=1)
    return pd.DataFrame({
        "shard": [pdf["shard"].iloc[0]], "n_keys": [len(slot)], "level_bits": [sizes], "bits": [np.packbits(bits).tobytes()],
        "spare": [spare.tobytes()], "fingerprints": [fingerprints.tobytes()], "counts": [counts.tobytes()],
        "firsts": [firsts.tobytes()], "heavy": [heavy.tobytes()],
    })


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text_bytes(text_col).alias("t"))


def _batch_digests(b: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(document of every digest, digests as two words) of a batch."""
    ids, raw, owner = b.column(0).to_numpy(zero_copy_only=False), [], []
    for i, t in enumerate(b.column(1).to_pylist()):
        d = doc_digests(t, min_chars)
        raw.extend(d)
        owner.extend([i] * len(d))
    h = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
    return ids[np.array(owner, np.int64)] if owner else np.empty(0, np.int64), h


def count_lines(docs: DataFrame, text_col: str = "text") -> int:
    """Lines of the corpus (one number to the driver): decides the number of shards."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return docs.agg(F.sum(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0


def heavy_floor(lines: int) -> int:
    """Documents from which a line is heavy. At most ``lines / floor`` lines can be: under 2**20
    of 24 bytes for any corpus, and under 1,000 where ``lines`` is below four million."""
    return max(4096, lines >> 20)


def build_line_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS, lines: int | None = None,
) -> tuple[DataFrame, int]:
    """(index with one row a shard, number of shards) over all lines of ``docs``."""
    lines = count_lines(docs, text_col) if lines is None else lines
    shards, heavy_from = max(1, -(-lines // shard_keys)), heavy_floor(lines)

    def seen(batches):
        for b in batches:
            doc, h = _batch_digests(b, min_chars)
            if not len(doc):
                continue
            order = np.lexsort((h[:, 1], h[:, 0]))
            h, doc = h[order], doc[order]
            start = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]).any(axis=1)])
            h1 = h[start, 0]
            yield batch(
                SEEN, (h1.view(np.uint64) % np.uint64(shards)).astype(np.int64), h1, h[start, 1],
                np.minimum.reduceat(doc, start), np.maximum.reduceat(doc, start), np.diff(np.r_[start, len(doc)]),
            )

    rows = _source(docs, id_col, text_col).mapInArrow(seen, "shard long, h1 long, h2 long, first long, last long, n long")
    return rows.groupBy("shard").applyInPandas(lambda pdf: _build_shard(pdf, heavy_from), INDEX), shards


def find_repeats(
    docs: DataFrame, index: DataFrame, shards: int, heavy: dict[bytes, int], id_col: str, text_col: str, min_chars: int,
) -> DataFrame:
    """``(doc, drops)``: digests (16 bytes each) of the lines that a document must drop, heavy lines excepted."""
    known = docs.sparkSession.sparkContext.broadcast(heavy)

    def probes(batches):
        for b in batches:
            doc, h = _batch_digests(b, min_chars)
            if known.value and len(doc):
                light = np.fromiter((d.tobytes() not in known.value for d in h), bool, len(h))
                doc, h = doc[light], h[light]
            if len(doc):
                yield batch(PROBE, (h[:, 0].view(np.uint64) % np.uint64(shards)).astype(np.int64), doc, h[:, 0], h[:, 1])

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"doc": pd.Series(dtype="int64"), "digest": pd.Series(dtype="object")})
        if not len(left) or not len(right):
            return none
        ix = LineIndex(left.iloc[0])
        h = right[["h1", "h2"]].to_numpy(np.int64)
        s = ix.slots(h[:, 0].copy().view(np.uint64), h[:, 1].copy().view(np.uint64))
        hit = s >= 0
        hit[hit] = (ix.counts[s[hit]] > 1) & (ix.firsts[s[hit]] != right["doc"].to_numpy()[hit])
        if not hit.any():
            return none
        return pd.DataFrame({"doc": right["doc"].to_numpy()[hit], "digest": [x.tobytes() for x in h[hit]]})

    asked = _source(docs, id_col, text_col).mapInArrow(probes, "shard long, doc long, h1 long, h2 long")
    hits = index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(answer, "doc long, digest binary")
    return hits.groupBy("doc").agg(F.collect_list("digest").alias("drops"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS, keep_text: bool = True,
) -> DataFrame:
    """All rows and columns with repeated lines cut from ``text_col``, plus ``n_lines``, ``n_dropped``
    and ``kept_sha256`` (columns of these names are replaced; without ``keep_text`` the text itself
    and the other columns are left out).

    A line repeats if its key (ends stripped of white space, A-Z lowered) has at least
    ``min_chars`` code points and stands in two documents; only the document with the smallest
    id keeps it, with all its occurrences there. Null and empty texts are one empty line and
    come back empty. Rows of equal id are one document: none of them drops a line for
    another. Null ids count as one document after all others. An empty table stays empty."""
    spark = docs.sparkSession
    index, shards = build_line_index(docs, id_col, text_col, min_chars, shard_keys)
    index = cut_lineage(index)
    heavy: dict[bytes, int] = {}
    for r in index.where(F.length("heavy") > 0).select("heavy").toLocalIterator():  # bounded: heavy_floor
        for h1, h2, first in np.frombuffer(r["heavy"], np.int64).reshape(-1, 3):
            heavy[np.array([h1, h2], np.int64).tobytes()] = int(first)
    known = spark.sparkContext.broadcast(heavy)
    drops = find_repeats(docs, index, shards, heavy, id_col, text_col, min_chars)

    new = ["n_lines", "n_dropped", "kept_sha256"]
    keep = [c for c in docs.columns if c not in (*new, text_col)] if keep_text else [id_col]
    src = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__doc"), text_bytes(text_col).alias("__t"),
        F.struct(*keep).alias("__row"),
    )
    src = src.join(drops.select(F.col("doc").alias("__doc"), F.col("drops").alias("__drops")), "__doc", "left")
    src = src.select("__doc", "__t", "__drops", "__row")

    def cut(batches):
        for b in batches:
            texts, n_lines, n_dropped, digests = [], [], [], []
            for doc, t, drop in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines, gone = t.split(b"\n"), set(drop or ())
                if gone or known.value:
                    left = []
                    for x in lines:
                        k = line_key(x, min_chars)
                        if k is not None:
                            d = xxhash.xxh3_128_digest(k)
                            if d in gone or known.value.get(d, doc) != doc:
                                continue
                        left.append(x)
                else:
                    left = lines
                t = b"\n".join(left)
                texts.append(t)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                digests.append(hashlib.sha256(t).hexdigest())
            out = [b.column(3), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())]
            names = ["row", *new]
            if keep_text:
                out.append(pa.array([t.decode(errors="replace") for t in texts], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(out, names=names)

    row = src.schema["__row"].dataType.simpleString()
    shape = f"row {row}, n_lines long, n_dropped long, kept_sha256 string" + (", text string" if keep_text else "")
    got = src.mapInArrow(cut, shape)
    if not keep_text:
        return got.select(F.col("row").getField(id_col).cast("long").alias(id_col), *new)
    cols = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    return got.select(*cols, *new)
