"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of up to ``frame_units`` code points, with the
cumulative number of code points at the end of each frame. Cutting a text at two points then
decompresses the frames that hold a cut and no others: frames that lie whole in the prefix, the
middle or the suffix go into the output as they are, in their new order. The output is framed in the
same way, so it is itself seekable; its digest and the text rebuilt from it are streamed one frame at
a time, in order, whatever the text's length.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm.common import batch, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FRAME_UNITS = 1 << 14
LEVEL = 3


@dataclass(frozen=True)
class Rule:
    """How forms are drawn: percentages of a hash of ``seed`` and the document's id."""

    seed: int = 1
    changed_percent: int = 90   # the rest stays plain
    spm_percent: int = 20       # of the changed ones; the rest is psm


def _compress(text: str) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(text.encode())


def _decompress(frame: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(frame).decode()


class Frames:
    """A text as compressed frames; ``ends`` counts the code points up to the end of each."""

    def __init__(self, frames: list[bytes], ends: list[int]):
        self.frames, self.ends = frames, ends

    @classmethod
    def of(cls, parts: Iterable[tuple[bytes, int]]) -> "Frames":
        frames, ends, at = [], [], 0
        for frame, units in parts:
            if units:
                at += units
                frames.append(frame)
                ends.append(at)
        return cls(frames, ends)

    @classmethod
    def store(cls, text: str, frame_units: int = FRAME_UNITS) -> "Frames":
        cuts = range(0, len(text), frame_units)
        return cls([_compress(text[i:i + frame_units]) for i in cuts], [min(i + frame_units, len(text)) for i in cuts])

    @property
    def units(self) -> int:
        return self.ends[-1] if self.ends else 0

    def _overlaps(self, lo: int, hi: int) -> Iterator[tuple[int, int, int, int]]:
        """(frame, its start, from, to) of the frames that hold code points ``lo`` to ``hi - 1``."""
        k = bisect_right(self.ends, lo)
        while k < len(self.ends) and lo < hi:
            stop = min(hi, self.ends[k])
            yield k, (self.ends[k - 1] if k else 0), lo, stop
            lo, k = stop, k + 1

    def select(self, lo: int, hi: int) -> Iterator[tuple[bytes, int]]:
        """Frames of a range: whole ones as they are, cut ones decompressed and cut."""
        for k, start, i, j in self._overlaps(lo, hi):
            whole = i == start and j == self.ends[k]
            yield (self.frames[k] if whole else _compress(_decompress(self.frames[k])[i - start:j - start])), j - i

    def stream(self, lo: int = 0, hi: int | None = None) -> Iterator[str]:
        """The text of a range, one frame at a time."""
        for k, start, i, j in self._overlaps(lo, self.units if hi is None else hi):
            yield _decompress(self.frames[k])[i - start:j - start]

    def find(self, mark: str, lo: int) -> int:
        """Position of the first ``mark`` at or after ``lo``, which may span frames; -1 if none."""
        tail = ""
        for part in self.stream(lo):
            at = (tail + part).find(mark)
            if at >= 0:
                return lo - len(tail) + at
            lo += len(part)
            tail = (tail + part)[-(len(mark) - 1):]
        return -1


_MARKS = {m: (_compress(m), len(m)) for m in (PREFIX, SUFFIX, MIDDLE)}


def has_mark(text: str) -> bool:
    return PREFIX in text or SUFFIX in text or MIDDLE in text


def plan(doc_id: int | None, units: int, marked: bool, rule: Rule) -> tuple[str, int, int]:
    """(form, end of the prefix, end of the middle) of a document. A null id draws as ``null``."""
    h = hashlib.sha256(f"{rule.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not units or marked or h3 % 100 >= rule.changed_percent:
        return "plain", 0, 0
    a, b = sorted((h1 % (units + 1), h2 % (units + 1)))
    return ("spm" if h4 % 100 < rule.spm_percent else "psm"), a, b


def rearrange(text: Frames, form: str, a: int, b: int) -> Frames:
    """The output of a document, framed."""
    if form == "plain":
        return text
    prefix, middle, suffix = text.select(0, a), text.select(a, b), text.select(b, text.units)
    first, second = ((SUFFIX, suffix), (PREFIX, prefix)) if form == "spm" else ((PREFIX, prefix), (SUFFIX, suffix))

    def parts():
        for mark, frames in (first, second, (MIDDLE, middle)):
            yield _MARKS[mark]
            yield from frames

    return Frames.of(parts())


def restore(output: Frames, form: str) -> Iterator[str]:
    """The original text, streamed from an output and its form alone."""
    if form == "plain":
        yield from output.stream()
        return
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    i = len(first)
    j = output.find(second, i)
    m = output.find(MIDDLE, j + len(second))
    one, two = (i, j), (j + len(second), m)
    middle = (m + len(MIDDLE), output.units)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    for lo, hi in (prefix, middle, suffix):
        yield from output.stream(lo, hi)


def digest(parts: Iterable[str]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode())
    return h.hexdigest()


# --- tables ----------------------------------------------------------------------------------
FRAMED = "doc_id long, marked boolean, ends array<long>, frames array<binary>"
_FRAMED = pa.schema([("doc_id", pa.int64()), ("marked", pa.bool_()), ("ends", pa.list_(pa.int64())), ("frames", pa.list_(pa.binary()))])


def store_texts(docs: DataFrame, path: str, frame_units: int = FRAME_UNITS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes every text as frames to ``path``: one row a document, ``FRAMED``. ``marked`` tells whether the
    text holds one of the marks. Nulls are stored as the empty text, which has no frames; repeated rows
    and null ids are stored each; further columns are ignored, whatever their names."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))

    def run(batches):
        for b in batches:
            marked, ends, frames = [], [], []
            for t in b.column(1):
                text = t.as_py().decode(errors="replace")
                f = Frames.store(text, frame_units)
                marked.append(has_mark(text))
                ends.append(f.ends)
                frames.append(f.frames)
            yield batch(_FRAMED, b.column(0), marked, ends, frames)

    src.mapInArrow(run, FRAMED).write.option("compression", "uncompressed").parquet(path)


def _outputs(b: pa.RecordBatch, rule: Rule) -> Iterator[tuple[int, str, int, int, Frames]]:
    """(code points, form, prefix end, middle end, output) of the rows of a batch of ``FRAMED``."""
    doc_ids, marks, ends = (b.column(i).to_pylist() for i in range(3))
    for doc_id, marked, e, frames in zip(doc_ids, marks, ends, b.column(3)):
        text = Frames([x.as_py() for x in frames.values], e)
        form, i, j = plan(doc_id, text.units, marked, rule)
        yield text.units, form, i, j, rearrange(text, form, i, j)


def _cuts(rows: list[tuple[int, str, int, int, object]]) -> list[list]:
    plain = [r[1] == "plain" for r in rows]
    return [
        [r[0] for r in rows], [r[1] for r in rows],
        [None if p else r[2] for p, r in zip(plain, rows)], [None if p else r[3] - r[2] for p, r in zip(plain, rows)],
    ]


_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def transform(spark: SparkSession, path: str, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, ends, frames)`` of the texts stored at ``path``:
    the rearranged text as frames of the same kind. An empty text or one that holds a mark stays plain."""
    out = pa.schema([*_HEAD, ("ends", pa.list_(pa.int64())), ("frames", pa.list_(pa.binary()))])

    def run(batches):
        for b in batches:
            rows = list(_outputs(b, rule))
            yield batch(out, b.column(0), *_cuts(rows), [r[4].ends for r in rows], [r[4].frames for r in rows])

    return spark.read.schema(FRAMED).parquet(path).mapInArrow(run, f"{HEAD}, ends array<long>, frames array<binary>")


def transform_digests(spark: SparkSession, path: str, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``: digests of what
    ``transform`` returns and of the texts rebuilt from that, without moving frames. Same cases."""
    out = pa.schema([*_HEAD, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def run(batches):
        for b in batches:
            rows = [(*r[:4], digest(r[4].stream()), digest(restore(r[4], r[1]))) for r in _outputs(b, rule)]
            yield batch(out, b.column(0), *_cuts(rows), [r[4] for r in rows], [r[5] for r in rows])

    return spark.read.schema(FRAMED).parquet(path).mapInArrow(run, f"{HEAD}, output_sha256 string, restored_sha256 string")
