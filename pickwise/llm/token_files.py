"""Token ids of a corpus as segment files with Elias-Fano coded document boundaries.

1. Documents are range-partitioned and sorted by id, so partition p holds the ids just before
   those of partition p + 1, and every task encodes its own documents.
2. A task cuts its documents into segments of about ``segment_tokens`` ids. A segment's image is
   self-contained: the concatenated ids (two bytes each while the vocabulary allows it), the
   documents' ends and the documents' ids. Both sequences ascend, so both are Elias-Fano coded:
   the low bits of every value packed at a fixed width, the high bits as unary gaps in a bit
   vector, about 2 + log2(universe / n) bits a value. Positions of every 256th one are kept in 32
   bits each; ``select`` starts there, so an offset is found without a table of offsets.
3. A segment is a row (part, seg, base, ..., image) of a Parquet table that Spark's commit protocol
   writes: lost executors and repeated attempts leave no half-written segment. ``base`` counts the
   part's ids before the segment; the ids before a part follow from one sum per part.

Memory is bounded by a segment and the longest single document.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickwise.functions.broadcast import checked
from pickwise.llm.chunks import ChunkEncoder
from pickwise.llm.common import batch, task_count, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"PWTOKEF1"
SAMPLE = 256                    # ones between two kept positions of a bit vector
SEGMENT_TOKENS = 1 << 20
SEGMENT_DOCS = 1 << 16
TASK_BYTES = 32 << 20           # text of one task of the sorted write
MAX_WANTED = 1_000_000          # ids that ``fetch_documents`` sends to every task


# --- Elias-Fano ----------------------------------------------------------------------------
def _pack(values: np.ndarray, width: int) -> bytes:
    """Values (unsigned 64-bit) of ``width`` bits each, little endian, without gaps."""
    if not width or not len(values):
        return b""
    shifts, out = np.arange(width, dtype=np.uint64), []
    for at in range(0, len(values), 1 << 15):  # a multiple of 8 values: chunks end on whole bytes
        bits = (values[at:at + (1 << 15), None] >> shifts) & np.uint64(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def _unpack(raw: np.ndarray, width: int, lo: int, hi: int) -> np.ndarray:
    if not width or hi <= lo:
        return np.zeros(max(hi - lo, 0), np.uint64)
    first = lo * width
    bits = np.unpackbits(raw[first // 8:(hi * width + 7) // 8], bitorder="little")[first % 8:][:(hi - lo) * width]
    return (bits.reshape(-1, width).astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def ef_encode(values: np.ndarray) -> bytes:
    """Image of a non-decreasing sequence of unsigned 64-bit values."""
    v = values.astype(np.uint64)
    n, top = len(v), int(v[-1]) if len(v) else 0
    width = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
    ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
    size = int(ones[-1]) + 1 if n else 0
    high = np.zeros(size, np.uint8)
    high[ones] = 1
    low, high = _pack(v, width), np.packbits(high, bitorder="little").tobytes()
    kept = ones[::SAMPLE].astype("<u4").tobytes()
    return struct.pack("<BIII", width, n, len(low), len(high)) + low + high + kept


class EliasFano:
    """Reader of ``ef_encode``'s image, over a buffer that it does not copy."""

    def __init__(self, raw: memoryview, at: int = 0):
        self.width, self.n, n_low, n_high = struct.unpack_from("<BIII", raw, at)
        at += struct.calcsize("<BIII")
        self.low = np.frombuffer(raw, np.uint8, n_low, at)
        self.high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        self.kept = np.frombuffer(raw, "<u4", -(-self.n // SAMPLE), at + n_low + n_high)
        self.end = at + n_low + n_high + 4 * len(self.kept)

    def select(self, lo: int, hi: int) -> np.ndarray:
        """Positions of the ones number ``lo`` to ``hi - 1`` in the high part: only the bits
        between the kept positions around them are read."""
        if hi <= lo:
            return np.empty(0, np.int64)
        block, last = lo // SAMPLE, (hi - 1) // SAMPLE + 1
        first = int(self.kept[block]) // 8
        stop = int(self.kept[last]) // 8 + 1 if last < len(self.kept) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:stop], bitorder="little")) + first * 8
        skip = int(np.searchsorted(ones, int(self.kept[block]))) + lo - block * SAMPLE
        return ones[skip:skip + hi - lo]

    def values(self, lo: int, hi: int) -> np.ndarray:
        """Values number ``lo`` to ``hi - 1``."""
        high = (self.select(lo, hi) - np.arange(lo, max(lo, hi))).astype(np.uint64)
        return (high << np.uint64(self.width)) | _unpack(self.low, self.width, lo, hi)

    def below(self, x: int) -> int:
        """Number of values smaller than ``x``, by binary search with ``select``."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            if int(self.values(mid, mid + 1)[0]) < x:
                lo = mid + 1
            else:
                hi = mid
        return lo


# --- segment images ------------------------------------------------------------------------
def segment_image(doc_ids: list[int | None], lengths: list[int], ids: bytes, id_bytes: int) -> bytes:
    """Image of one segment: documents in ascending id order, null ids first."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    ends = ef_encode(np.cumsum(np.asarray(lengths, np.int64)))
    # differences of 64-bit ids may exceed 63 bits: they are taken modulo 2^64
    names = ef_encode(np.asarray(known, np.int64).view(np.uint64) - np.int64(base).astype(np.uint64))
    head = struct.pack("<8sBIIqQ", MAGIC, id_bytes, len(doc_ids), len(doc_ids) - len(known), base, len(ids))
    return head + ids + ends + names


class Segment:
    """Reader of one segment image."""

    def __init__(self, image: bytes):
        raw = memoryview(image)
        magic, self.id_bytes, self.n_docs, self.n_null, self.base, size = struct.unpack_from("<8sBIIqQ", raw)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = struct.calcsize("<8sBIIqQ")
        self.ids = np.frombuffer(raw, f"<u{self.id_bytes}", size // self.id_bytes, at)
        self.ends = EliasFano(raw, at + size)
        self.names = EliasFano(raw, self.ends.end)

    def bounds(self, lo: int, hi: int) -> np.ndarray:
        """Start of document ``lo`` and the ends of documents ``lo`` to ``hi - 1``."""
        if lo:
            return self.ends.values(lo - 1, hi).astype(np.int64)
        return np.concatenate([np.zeros(1, np.int64), self.ends.values(0, hi).astype(np.int64)])

    def doc_ids(self, lo: int, hi: int) -> list[int | None]:
        n = self.n_null
        known = self.names.values(max(lo - n, 0), max(hi - n, 0)) + np.int64(self.base).astype(np.uint64)
        return [None] * max(min(hi, n) - lo, 0) + known.view(np.int64).tolist()

    def find(self, doc_id: int) -> tuple[int, int]:
        """Range of the documents that carry this id."""
        x = doc_id - self.base
        if x < 0:
            return 0, 0
        return self.n_null + self.names.below(x), self.n_null + self.names.below(x + 1)


# --- writing -------------------------------------------------------------------------------
SEGMENTS = "part int, seg int, base long, n_docs int, n_tokens long, first_doc long, last_doc long, image binary"
_SEGMENTS = pa.schema([
    ("part", pa.int32()), ("seg", pa.int32()), ("base", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()),
    ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("image", pa.binary()),
])


def _segments(rows: Iterator[tuple[int | None, np.ndarray]], part: int, segment_tokens: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``SEGMENTS`` for a task's documents, given in ascending order with their ids."""
    seg = base = held = 0
    names, lengths, parts = [], [], []

    def close():
        known = [d for d in names if d is not None]
        image = segment_image(names, lengths, b"".join(parts), width)
        return batch(_SEGMENTS, [part], [seg], [base], [len(names)], [held], known[:1] or [None], known[-1:] or [None], [image])

    width = 2
    for doc, ids in rows:
        width = ids.itemsize
        if names and (held + len(ids) > segment_tokens or len(names) >= SEGMENT_DOCS):
            yield close()
            seg, base, held = seg + 1, base + held, 0
            names, lengths, parts = [], [], []
        names.append(doc)
        lengths.append(len(ids))
        parts.append(ids.tobytes())
        held += len(ids)
    if names:
        yield close()


def write_token_files(
    docs: DataFrame, tokenizer_file: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    segment_tokens: int = SEGMENT_TOKENS, task_bytes: int = TASK_BYTES,
) -> None:
    """Writes the segment table of ``docs`` to ``path`` (a new folder that all executors reach).

    Documents stand in ascending id order, null ids first; rows of one id (repeated rows too) each
    stand for themselves, in the order of a hash of their text. A null or empty text is
    ``end_id`` alone. Further columns are ignored, whatever their names. An empty table gives an
    empty folder of segments. The tokenizer's file is read by the driver and sent to the workers."""
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(open(tokenizer_file, encoding="utf-8").read())
    src = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("t"))
    size = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    # equal ids, and even equal rows, may fill a partition of their own: the last key deals them out
    src = src.withColumn("tie", F.xxhash64("t")).withColumn("at", F.monotonically_increasing_id())
    order = [F.col("doc").asc_nulls_first(), "tie", "at"]
    ranged = src.repartitionByRange(task_count(spark, size, task_bytes), *order).sortWithinPartitions(*order).select("doc", "t")

    def encode(batches):
        encoder = ChunkEncoder.of(raw.value)
        end = np.array([end_id], encoder.dtype if end_id < 1 << 16 else np.uint32)

        def rows():
            for b in batches:
                for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = encoder.encode(t.as_py().decode(errors="replace"))
                    yield doc, np.concatenate([ids, end])

        yield from _segments(rows(), TaskContext.get().partitionId(), segment_tokens)

    (
        ranged.mapInArrow(encode, SEGMENTS).write.option("compression", "zstd")
        # images are large rows: look at the sizes after every one
        .option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1)
        .parquet(path)
    )


# --- reading -------------------------------------------------------------------------------
def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segment table with ``start``, the number of ids before each segment."""
    rows = spark.read.schema(SEGMENTS).parquet(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per task of the write: the window runs over that small table
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = checked(sums.select("part", before.alias("before")))
    return rows.join(sums, "part").withColumn("start", F.col("before") + F.col("base")).drop("before")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the segments: the ids
    of all documents before it, its own number of ids, and the crc32 of its ids as little-endian
    unsigned 32-bit integers."""

    def read(batches):
        for b in batches:
            for start, image in zip(b.column(0).to_pylist(), b.column(1)):
                s = Segment(image.as_buffer())
                for lo in range(0, s.n_docs, 1 << 14):
                    hi = min(lo + (1 << 14), s.n_docs)
                    cut = s.bounds(lo, hi)
                    crc = [zlib.crc32(s.ids[i:j].astype("<u4").tobytes()) for i, j in zip(cut[:-1], cut[1:])]
                    yield batch(_DOCUMENTS, s.doc_ids(lo, hi), cut[:-1] + start, np.diff(cut), crc)

    return segments(spark, path).select("start", "image").mapInArrow(read, DOCUMENTS)


def fetch_documents(spark: SparkSession, path: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids)`` of the stored documents whose id is in ``wanted``, found by select in the
    segments whose id range holds one. Nulls and unknown ids give no row, repeated ids one each.

    Up to ``MAX_WANTED`` distinct ids go to every task; beyond it all documents are read and joined."""
    ids = wanted.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    few = ids.limit(MAX_WANTED + 1).count() <= MAX_WANTED
    keys = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in ids.toLocalIterator()], np.int64)) if few else None)
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def read(batches):
        for b in batches:
            for image in b.column(0):
                s, docs, found = Segment(image.as_buffer()), [], []
                if keys.value is None:
                    spans = [(s.n_null, s.n_docs)]
                else:
                    last = s.doc_ids(s.n_docs - 1, s.n_docs)[0] if s.n_docs > s.n_null else s.base - 1
                    k = keys.value[np.searchsorted(keys.value, s.base):np.searchsorted(keys.value, last, "right")]
                    spans = [s.find(int(x)) for x in k]
                for lo, hi in spans:
                    for at in range(lo, hi):
                        i, j = s.bounds(at, at + 1)
                        docs += s.doc_ids(at, at + 1)
                        found.append(s.ids[i:j].astype(np.int32))
                yield batch(out, docs, found)

    got = spark.read.schema(SEGMENTS).parquet(path).where("last_doc is not null").select("image").mapInArrow(read, "doc_id long, ids array<int>")
    return got if few else got.join(ids, "doc_id", "left_semi")
