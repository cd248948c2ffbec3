"""Benchmark decontamination by latent semantic retrieval, then alignment checks.

1. **Terms.** The vocabulary is the benchmark's words. Every document becomes the sequence of its term
   numbers (0: no term), with how many passages hold each term: the corpus statistics for
   TF-IDF, counted over all passages of all documents. The sequences are written once to the shared
   folder; later steps read them instead of the texts.
2. **Latent space.** A randomised SVD of the TF-IDF passage matrix ``A``: tasks form ``A^T (A W)`` for one random
   test matrix ``W``, the driver adds the benchmark's own passages and takes the leading right singular
   vectors from the sum (one-pass Nystrom form). All passages of all documents enter it.
3. **Candidates.** Sliding windows of all documents are projected and compared with the projected benchmark
   passages; a window's length suits the passage's and a term counts once in it. A window is a candidate by its
   cosine, or by how much of the passage's vector it covers: text around the passage turns the window's vector
   away, but takes nothing from what is covered.
4. **Checks.** Around a candidate window, the longest common subsequence with the benchmark passage must cover
   ``min_lcs`` of it, and its answer (the last quarter of the words) ``min_answer``. Words may be
   added, dropped or replaced: paraphrases pass, shared small words do not.

The benchmark is searched in slices of at most ``slice_words`` words, so what is broadcast is bounded;
a larger benchmark takes more rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import batch, text_bytes
from pickwise.session import cut_lineage, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Params:
    rank: int = 160             # latent dimensions
    oversample: int = 16
    fit_passages: int = 128     # passages multiplied at once in the fit, which takes all of them
    min_cosine: float = 0.55
    min_cover: float = 0.4      # of the passage's latent vector, whatever else the window holds
    min_lcs: float = 0.7
    min_answer: float = 0.6
    block: int = 16             # words a block; windows are 2, 4 or 8 blocks
    passage_words: int = 64     # longer benchmark items are cut
    common: float = 0.4         # terms in a larger share of the passages have no weight (but see FLOOR)
    slice_words: int = 200_000
    seed: int = 11


WINDOWS = (2, 4, 8)
FLOOR = 0.05  # weight of the terms of a benchmark passage that has no other
SIGNS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lowered; signs and white space cut."""
    return text.lower().translate(SIGNS).split()


@dataclass
class Benchmark:
    """Passages of one slice of the benchmark as term sequences."""

    vocab: dict[bytes, int]     # 1, 2, ...
    items: list[int]            # item of every passage
    terms: list[np.ndarray]
    window: list[int]           # blocks of the window that suits the passage

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]], p: Params) -> "Benchmark":
        out = cls({}, [], [], [])
        for item, text in rows:
            w = words_of(text)
            n = max(1, -(-len(w) // p.passage_words))
            for part in np.array_split(np.array([out.vocab.setdefault(x, len(out.vocab) + 1) for x in w], np.int64), n):
                if len(part):
                    out.items.append(item)
                    out.terms.append(part)
                    out.window.append(next((b for b in WINDOWS if b * p.block >= 1.5 * len(part)), WINDOWS[-1]))
        return out


def slices(benchmark: DataFrame, p: Params, id_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """Benchmark rows in slices of bounded size, one at a time; rows without an id or a word are left out."""
    part, held = [], 0
    rows = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), text_bytes(text_col).alias("t"))
    for r in rows.orderBy("i", "t").toLocalIterator():
        n = len(words_of(r["t"]))
        if n:
            if part and held + n > p.slice_words:
                yield part
                part, held = [], 0
            part.append((r["i"], bytes(r["t"])))
            held += n
    if part:
        yield part


def _passage_pairs(seqs: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (passage, term) pairs of a batch and the number of passages (``width`` words each)."""
    n = np.array([len(s) for s in seqs], np.int64)
    parts = -(-n // width)
    base = np.r_[0, np.cumsum(parts)]
    flat = np.concatenate(seqs) if seqs else np.empty(0, np.int64)
    pos = np.arange(len(flat)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else flat
    passage = np.repeat(base[:-1], n) + pos // width
    on = flat > 0
    key = np.unique(passage[on] * (1 << 32) + flat[on].astype(np.int64))
    return key >> 32, key & 0xFFFFFFFF, int(base[-1])


TERMS = pa.schema([("doc", pa.int64()), ("terms", pa.binary()), ("passages", pa.int64()), ("held", pa.list_(pa.int32())), ("df", pa.list_(pa.int32()))])


def _term_table(docs: DataFrame, bench, p: Params, id_col: str, text_col: str) -> DataFrame:
    """One row a document (doc, terms) and one row a batch (passages, held, df: passages per term)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("t"))

    def run(batches):
        get, wide = bench.value.get, len(bench.value) >= 1 << 16
        for b in batches:
            seqs = []
            for t in b.column(1).to_pylist():
                w = words_of(t)
                seqs.append(np.fromiter(map(get, w, [0] * len(w)), np.int64, len(w)))
            _, term, n = _passage_pairs(seqs, 2 * p.block)
            held, df = np.unique(term, return_counts=True)
            raw = [s.astype(np.uint32 if wide else np.uint16).tobytes() for s in seqs] + [None]
            none = [None] * len(seqs)
            yield batch(
                TERMS, pa.array([*b.column(0).to_pylist(), None], pa.int64()), raw, [*none, n],
                [*none, held.astype(np.int32)], [*none, df.astype(np.int32)],
            )

    return src.mapInArrow(run, "doc long, terms binary, passages long, held array<int>, df array<int>")


SKETCH = pa.schema([("at", pa.int32()), ("z", pa.binary())])
SKETCH_TERMS = 64  # terms of one row of a sketch


def _sketches(parts: DataFrame) -> DataFrame:
    """Sums of the rows (at, z) that carry the same terms."""
    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                z = np.frombuffer(z, np.float32).astype(np.float64)
                held[at] = held[at] + z if at in held else z
        for at, z in held.items():
            yield batch(SKETCH, [at], [z.tobytes()])

    return parts.repartition("at").mapInArrow(add, "at int, z binary")


def _fit(terms: DataFrame, bench: Benchmark, weight: np.ndarray, n_passages: int, p: Params) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the TF-IDF matrix of all passages."""
    rng = np.random.default_rng(p.seed)
    size = len(weight)
    r = min(p.rank + p.oversample, size)
    test = rng.standard_normal((size, r)).astype(np.float32)
    shared = terms.sparkSession.sparkContext.broadcast((weight, test))
    width, wide = 2 * p.block, size > 1 << 16

    def sketch(batches):
        weight, test = shared.value
        z, rows = np.zeros(test.shape, np.float32), []
        for b in batches:
            for raw in b.column(0).to_pylist():
                t = np.frombuffer(raw, np.uint32 if wide else np.uint16)
                rows += [t[at:at + width] for at in range(0, len(t), width)]
                while len(rows) >= p.fit_passages:
                    _add_gram(z, rows[:p.fit_passages], weight, test)
                    rows = rows[p.fit_passages:]
        _add_gram(z, rows, weight, test)
        for at in range(0, len(z), SKETCH_TERMS):
            if z[at:at + SKETCH_TERMS].any():
                yield batch(SKETCH, [at], [z[at:at + SKETCH_TERMS].tobytes()])

    z = np.zeros(test.shape)
    for row in _sketches(terms.select("terms").mapInArrow(sketch, "at int, z binary")).toLocalIterator():  # each term once
        z[row["at"]:row["at"] + SKETCH_TERMS] = np.frombuffer(row["z"]).reshape(-1, r)
    # the benchmark's passages weigh as much as the corpus
    own = max(1.0, n_passages / max(1, len(bench.terms)))
    mine = np.zeros(test.shape)
    for at in range(0, len(bench.terms), 512):
        _add_gram(mine, bench.terms[at:at + 512], weight, test)
    z += own * mine
    core = test.T.astype(float) @ z
    core = (core + core.T) / 2
    lam, q = np.linalg.eigh(core)
    ok = lam > max(lam.max(), 1e-300) * 1e-10
    f = z @ (q[:, ok] / np.sqrt(lam[ok]))
    u, _, _ = np.linalg.svd(f, full_matrices=False)
    return u[:, :p.rank].astype(np.float32)


def _add_gram(z: np.ndarray, rows: list[np.ndarray], weight: np.ndarray, test: np.ndarray) -> None:
    """Adds ``A^T (A W)`` of a few passages given by their terms (each counts once); rows of ``A`` have unit length."""
    if not rows:
        return
    term = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    on = weight[term] > 0
    term, row = term[on], row[on]
    if not len(term):
        return
    held = np.zeros(len(weight), bool)
    held[term] = True
    used = np.flatnonzero(held)
    col = np.zeros(len(weight), np.int64)
    col[used] = np.arange(len(used))
    a = np.zeros((len(rows), len(used)), np.float32)
    a[row, col[term]] = weight[term]
    a /= np.maximum(np.sqrt(np.einsum("ij,ij->i", a, a)), 1e-30)[:, None]
    z[used] += a.T @ (a @ test[used])


def lcs_masks(pattern: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, t in enumerate(pattern.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    return masks


def lcs_length(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Length of the longest common subsequence of a pattern of ``n`` terms and a text (bit-parallel)."""
    full = (1 << n) - 1
    v = full
    for t in text:
        m = masks.get(t)
        if m:
            u = v & m
            v = (v + u) | (v - u)
    return n - (v & full).bit_count()


class Search:
    """Per-worker search of term sequences against one slice of the benchmark."""

    def __init__(self, bench: Benchmark, weight: np.ndarray, axes: np.ndarray, p: Params):
        self.bench, self.p = bench, p
        self.project = axes * weight[:, None]
        self.project[0] = 0
        q = np.stack([self.project[np.unique(t)].sum(axis=0) for t in bench.terms])
        self.size = np.maximum(1e-12, np.linalg.norm(q, axis=1))
        self.q = q / self.size[:, None]
        self.of_window = {b: np.flatnonzero(np.array(bench.window) == b) for b in WINDOWS}
        tail = lambda t: t[-max(3, len(t) // 4):]
        self.masks = [(lcs_masks(t), len(t)) for t in bench.terms]
        self.answers = [(lcs_masks(tail(t)), len(tail(t))) for t in bench.terms]

    def candidates(self, seqs: list[np.ndarray]):
        """(document, first word, words, passage, cosine) of window and benchmark passage pairs."""
        p = self.p
        n = np.array([len(s) for s in seqs], np.int64)
        flat = np.concatenate(seqs).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(flat)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
        on = self.weighted[flat]
        flat, doc, pos = flat[on], doc[on], pos[on]
        if not len(flat):
            return
        # where the document had the term before, so that a window counts it once
        key = doc << 32 | flat
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        before = np.full(len(flat), -(1 << 40))
        before[order[1:][same]] = pos[order[:-1][same]]
        for b in WINDOWS:
            mine = self.of_window[b]
            if not len(mine):
                continue
            half = b // 2 * p.block  # a window is a half and the next one
            halves = -(-n // half)
            base = np.r_[0, np.cumsum(halves + 1)]
            at, last = pos // half, before // half
            new = self._sums(flat, base[doc] + at, last < at - 1, int(base[-1]))
            w = new + self._sums(flat, base[doc] + at, last == at - 1, int(base[-1]))
            w[:-1] += new[1:]
            first = np.delete(np.arange(base[-1]), base[1:] - 1)
            w = w[first]
            dot = w @ self.q[mine].T
            cos = dot / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
            a, j = np.nonzero((cos >= p.min_cosine) | (dot >= p.min_cover * self.size[mine]))
            d = np.searchsorted(base, first[a], side="right") - 1
            for d, f, q, c in zip(d, first[a] - base[d], mine[j], cos[a, j]):
                yield int(d), int(f) * half, b * p.block, int(q), float(c)

    def _sums(self, flat: np.ndarray, of: np.ndarray, take: np.ndarray, size: int) -> np.ndarray:
        """Sums of the taken terms' vectors by ascending segment: the first terms of all segments, then the second, ..."""
        out = np.zeros((size, self.project.shape[1]), np.float32)
        flat, of = flat[take], of[take]
        if not len(flat):
            return out
        start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        n = np.diff(np.r_[start, len(of)])
        longest = np.argsort(-n, kind="stable")
        start, n = start[longest], n[longest]
        sums = self.project[flat[start]]
        for k in range(1, int(n[0])):
            m = int(np.searchsorted(-n, -k))  # segments of more than k terms
            sums[:m] += self.project[flat[start[:m] + k]]
        out[of[start]] = sums
        return out

    @property
    def weighted(self) -> np.ndarray:
        if not hasattr(self, "_on"):
            self._on = np.abs(self.project).sum(axis=1) > 0
        return self._on

    def check(self, seq: np.ndarray, at: int, width: int, q: int) -> tuple[float, float]:
        """Shares of the passage and of its answer found in order around a window."""
        side = width // 4
        text = [t for t in seq[max(0, at - side):at + width + side].tolist() if t]
        masks, n = self.masks[q]
        share = lcs_length(masks, n, text) / n
        if share < self.p.min_lcs:
            return share, 0.0
        masks, n = self.answers[q]
        return share, lcs_length(masks, n, text) / n


FOUND = pa.schema([
    ("doc", pa.int64()), ("items", pa.list_(pa.int64())), ("best_item", pa.int64()), ("lcs", pa.float64()),
    ("answer", pa.float64()), ("cosine", pa.float64()),
])


def _search_slice(docs: DataFrame, rows: list[tuple[int, bytes]], p: Params, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    bench = Benchmark.of(rows, p)
    size, wide = len(bench.vocab) + 1, len(bench.vocab) >= 1 << 16
    terms = cut_lineage(_term_table(docs, spark.sparkContext.broadcast(bench.vocab), p, id_col, text_col))
    n = terms.agg(F.sum("passages")).first()[0] or 0
    held = np.zeros(size)
    pair = F.explode(F.arrays_zip("held", "df")).alias("x")
    for r in terms.where("passages is not null").select(pair).groupBy("x.held").agg(F.sum("x.df").alias("n")).toLocalIterator():
        held[r["held"]] = r["n"]  # one row a term of the benchmark
    weight = np.log((n + 1) / (held + 1)).astype(np.float32)
    weight[held > p.common * max(1, n)] = 0
    # a passage of common terms alone must still be found: its terms keep a small weight
    for t in bench.terms:
        if not weight[t].any():
            weight[t] = FLOOR
    weight[0] = 0
    words = terms.where("passages is null")
    axes = _fit(words, bench, weight, n, p)
    shared = spark.sparkContext.broadcast((bench.items, bench.terms, bench.window, weight, axes))  # plain data only

    def run(batches):
        items, passages, window, weight, axes = shared.value
        search = Search(Benchmark({}, items, passages, window), weight, axes, p)
        for b in batches:
            docs_, seqs = b.column(0).to_pylist(), [np.frombuffer(x, np.uint32 if wide else np.uint16) for x in b.column(1).to_pylist()]
            out = [[] for _ in seqs]
            lo = 0
            while lo < len(seqs):
                hi, held = lo, 0
                while hi < len(seqs) and (hi == lo or held + len(seqs[hi]) <= 60_000):
                    held += len(seqs[hi])
                    hi += 1
                found: dict[tuple[int, int], tuple] = {}
                for d, at, width, q, c in search.candidates(seqs[lo:hi]) if held else ():
                    share, answer = search.check(seqs[lo + d], at, width, q)
                    if share >= p.min_lcs and answer >= p.min_answer:
                        key = (lo + d, items[q])
                        found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (share, answer, c))
                for (d, item), got in found.items():
                    out[d].append((*got, -item))  # the smallest id is the largest of equals
                lo = hi
            best = [max(x) if x else (None, None, None, None) for x in out]
            yield batch(
                FOUND, pa.array(docs_, pa.int64()), [sorted(-y[3] for y in x) for x in out],
                pa.array([None if x[3] is None else -x[3] for x in best], pa.int64()), *([x[k] for x in best] for k in range(3)),
            )

    return words.select("doc", "terms").mapInArrow(run, "doc long, items array<long>, best_item long, lcs double, answer double, cosine double")


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, contaminated, items, best_item, lcs, answer, cosine)`` for every row.

    ``items`` are the benchmark items found in the text, ascending; ``best_item`` is the one with the largest
    share in order, then answer share, cosine and smallest id; its figures follow. Null, empty and wordless
    texts are clean, with an empty list and null figures. Repeated rows are judged each; other columns are
    ignored. Benchmark items without words or id match nothing; without items all texts are clean."""
    cols = [F.col("doc").alias(id_col), (F.size("items") > 0).alias("contaminated"), "items", "best_item", "lcs", "answer", "cosine"]
    todo = slices(benchmark, p, item_id, item_text)
    first, second = next(todo, None), next(todo, None)
    if first is None:
        empty = docs.select(F.col(id_col).cast("long").alias("doc"))
        return empty.selectExpr("doc", "cast(array() as array<bigint>) as items", "cast(null as bigint) as best_item", *(f"cast(null as double) as {c}" for c in ("lcs", "answer", "cosine"))).select(*cols)
    if second is None:
        return _search_slice(docs, first, p, id_col, text_col).select(*cols)
    # several slices judge every row: their verdicts meet on a key of the row, written with it
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "keyed-rows")
    docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    keyed = spark.read.parquet(path)
    out = None
    for rows in chain((first, second), todo):
        part = cut_lineage(_search_slice(keyed, rows, p, "row", "text"))
        out = part if out is None else out.unionByName(part)
    best = F.max(F.when(F.col("best_item").isNotNull(), F.struct("lcs", "answer", "cosine", (-F.col("best_item")).alias("m"))))
    merged = out.groupBy(F.col("doc").alias("row")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best.alias("b"))
    merged = merged.join(keyed.select("row", F.col("id").alias("doc")), "row")
    return merged.select("doc", "items", (-F.col("b.m")).alias("best_item"), "b.lcs", "b.answer", "b.cosine").select(*cols)
