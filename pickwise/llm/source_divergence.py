"""Divergence of the sources of a language, from term stripes combined in the mappers.

1. Fold: every task folds whole documents into a hash of stripes, (language, term) -> (document
   frequency, count per source). When the hash holds ``max_cells`` counts it is spilled: its stripes go
   out as rows and the hash starts anew, so memory is bounded and a frequent term leaves a task once a
   spill, not once a document.
2. Merge: stripes are shuffled and sorted by (language, term); a task reads them in order and adds up
   neighbours, holding one term at a time. Terms in fewer than ``min_docs`` documents end here.
3. Emit: a merged stripe gives the smoothed probabilities of its term in every source of the language.
   A task adds up the divergence of all pairs of sources over its share of the terms. Sources are cut
   into blocks and terms are dealt by hash, so a task's counts, pairs and memory are bounded however
   many sources or terms a language has. Where both sources lack a term, their divergence is a
   constant: it is counted once for all terms and taken back for the terms that one of them has.

All arithmetic is in integers.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickwise.functions.broadcast import checked
from pickwise.functions.sequence import dense_positions
from pickwise.functions.topk import top_k
from pickwise.llm.common import batch
from pickwise.session import cut_lineage, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
MAX_CELLS = 250_000        # counts in a task's hash before it is spilled
SOURCE_BLOCK = 256         # sources in a block
TASK_CELLS = 50_000        # counts of one task of the last step, about

STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"
_STRIPES = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
# A-Z lowered; a-z and every byte of a character beyond ASCII kept; all other bytes part terms
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_DF = None  # the key of a stripe's document frequency among its sources


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


# --- fold ------------------------------------------------------------------------------------
def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _rows(lang: pa.Array, term: pa.Array, df, lengths: np.ndarray, codes, names: list[str], counts) -> pa.RecordBatch:
    """Stripes from flat arrays: ``lengths`` sources of each, as numbers into ``names``, and their counts."""
    sources = pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), pa.array(names, pa.string())).dictionary_decode()
    return batch(_STRIPES, lang, term, df, _lists(lengths, sources), _lists(lengths, pa.array(counts, pa.int64())))


def _fold(max_cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, dict]] = {}
        number: dict[str, int] = {}  # sources of this spill
        cells = 0

        def spill():
            names = list(number)
            for lang, found in stripes.items():
                terms = list(found)
                for at in range(0, len(terms), 1 << 15):
                    part = terms[at:at + (1 << 15)]
                    rows = [found[t] for t in part]
                    df = [r.pop(_DF) for r in rows]
                    yield _rows(
                        pa.repeat(lang, len(part)), pa.array(part, pa.string()), df, np.fromiter(map(len, rows), np.int64, len(rows)),
                        list(chain.from_iterable(rows)), names, list(chain.from_iterable(map(dict.values, rows))),
                    )
            stripes.clear()
            number.clear()

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang, name, text in zip(langs, sources, b.column(2)):
                found = stripes.setdefault(lang, {})
                source = number.setdefault(name, len(number))
                for term, n in Counter(terms_of(text.as_py())).items():
                    stripe = found.get(term)
                    if stripe is None:
                        found[term] = {_DF: 1, source: n}
                        cells += 1
                    else:
                        stripe[_DF] += 1
                        if source in stripe:
                            stripe[source] += n
                        else:
                            stripe[source] = n
                            cells += 1
                if cells >= max_cells:
                    yield from spill()
                    cells = 0
        yield from spill()

    return run


# --- merge -----------------------------------------------------------------------------------
def _merge(min_docs: int):
    """Adds up neighbouring stripes of one term; input is sorted by (lang, term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # [lang, term, df, {source: count}] of the last term read, which may go on

        def one(stripe):
            return _rows(
                pa.array([stripe[0]]), pa.array([stripe[1]]), [stripe[2]], np.array([len(stripe[3])]), range(len(stripe[3])), list(stripe[3]),
                list(stripe[3].values()),
            )

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            lang, term, df = b.column(0), b.column(1), b.column(2).to_numpy()
            new = np.ones(n, bool)
            if n > 1:
                same = pc.and_(pc.equal(lang.slice(1), lang.slice(0, n - 1)), pc.equal(term.slice(1), term.slice(0, n - 1)))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(df, starts)
            keep = sums >= min_docs
            keep[[0, -1]] = True  # the first term may continue the one held, the last may go on
            # counts per (kept term, source): cells of equal key are added up
            run_of_row = np.cumsum(new) - 1
            sizes = b.column(3).value_lengths().to_numpy()
            cell_run = np.repeat(run_of_row, sizes)
            wanted = keep[cell_run]
            names = b.column(3).flatten().filter(pa.array(wanted)).dictionary_encode()
            s = max(len(names.dictionary), 1)
            key = cell_run[wanted] * s + names.indices.to_numpy()
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            counts = np.add.reduceat(b.column(4).flatten().to_numpy()[wanted][order], first) if len(key) else np.empty(0, np.int64)
            owner, code = key[first] // s, key[first] % s
            words = names.dictionary.to_pylist()

            def stripe_of(k):
                i, j = np.searchsorted(owner, [k, k + 1])
                return [lang[int(starts[k])].as_py(), term[int(starts[k])].as_py(), int(sums[k]), {words[c]: x for c, x in zip(code[i:j].tolist(), counts[i:j].tolist())}]

            ends = [stripe_of(0)] + ([stripe_of(len(starts) - 1)] if len(starts) > 1 else [])
            if held is not None:
                if held[:2] == ends[0][:2]:
                    for name, x in held[3].items():
                        ends[0][3][name] = ends[0][3].get(name, 0) + x
                    ends[0][2] += held[2]
                elif held[2] >= min_docs:
                    yield one(held)
            held = ends[-1]
            if len(ends) > 1 and ends[0][2] >= min_docs:
                yield one(ends[0])
            keep[[0, -1]] = False
            if keep.any():
                at, cells = pa.array(starts[keep]), keep[owner]
                lengths = np.bincount(owner[cells], minlength=len(starts))[keep]
                yield _rows(lang.take(at), term.take(at), sums[keep], lengths, code[cells], words, counts[cells])
        if held is not None and held[2] >= min_docs:
            yield one(held)

    return run


def merged_stripes(docs: DataFrame, min_docs: int = MIN_DOCS, max_cells: int = MAX_CELLS) -> DataFrame:
    """Stripes ``(lang, term, df, sources, counts)`` of the terms in at least ``min_docs`` documents of a
    language, written to the shared folder. ``docs`` has ``lang, source, text``, none of them null."""
    spark = docs.sparkSession
    spilled = docs.select("lang", "source", F.encode("text", "UTF-8").alias("t")).mapInArrow(_fold(max_cells), STRIPES)
    path = scratch_path(spark, "stripes")
    by_term = spilled.repartition("lang", "term").sortWithinPartitions("lang", "term")
    by_term.mapInArrow(_merge(min_docs), STRIPES).write.parquet(path)
    return spark.read.schema(STRIPES).parquet(path)


# --- emit ------------------------------------------------------------------------------------
def probabilities(counts: np.ndarray, total: np.ndarray | int, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * n_terms)), digit by digit in base 1000 so that
    64 bits hold every step (totals below 9 * 10^15)."""
    d = np.asarray(total, np.int64) + 2 * n_terms
    rest = np.asarray(counts, np.int64) + 2
    p = rest // d
    rest = rest - p * d
    for _ in range(3):
        rest = rest * 1000
        digit = rest // d
        rest -= digit * d
        p = p * 1000 + digit
    return p + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


EMITTED = "lang string, part string, source string, item string, value long"


def _emit(top_terms: int, rows_at_once: int = 1 << 20):
    """Divergences of one (lang, block, block, share of terms): partial sums of pairs of sources, and the
    ``top_terms`` terms of each source of a block with itself."""

    def run(key, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        lang, x, y, share = key
        if not len(groups):
            return pd.DataFrame({c: [] for c in ("lang", "part", "source", "item", "value")})
        g = groups.drop_duplicates("no").sort_values("no")
        nos, names, totals = g["no"].to_numpy(), g["source"].to_numpy(), g["total"].to_numpy(np.int64)
        n, v, lang_total = len(nos), int(g["n_terms"].iloc[0]), int(g["lang_total"].iloc[0])
        pairs, terms = np.zeros((n, n), np.int64), []
        if v:
            base = probabilities(np.zeros(n, np.int64), totals, v)
            both_lack = divergence(base[:, None], base[None, :])
            if share == 0:
                pairs += v * both_lack
            code, term = pd.factorize(cells["term"])
            order = np.argsort(code, kind="stable")
            code, at = code[order], np.searchsorted(nos, cells["source_no"].to_numpy()[order])
            p = probabilities(cells["count"].to_numpy(np.int64)[order], totals[at], v)
            step = max(1, rows_at_once // n)
            for lo in range(0, len(term), step):
                i, j = np.searchsorted(code, [lo, lo + step])
                here = np.broadcast_to(base, (min(step, len(term) - lo), n)).copy()
                has = np.zeros(here.shape, bool)
                here[code[i:j] - lo, at[i:j]] = p[i:j]
                has[code[i:j] - lo, at[i:j]] = True
                for s in range(n):
                    rows = here[has[:, s]]
                    if len(rows):
                        more = divergence(rows[:, s:s + 1], rows) - both_lack[s]
                        pairs[s] += more.sum(axis=0)                       # source s has the term
                        pairs[:, s] += (more * ~has[has[:, s]]).sum(axis=0)  # s has it, the other has not
            if x == y and len(cells):
                q = probabilities(cells["lang_count"].to_numpy(np.int64)[order], lang_total, v)
                high = p > q
                t = pd.DataFrame({"source": names[at[high]], "item": np.asarray(term, object)[code[high]], "value": divergence(p[high], q[high])})
                terms = t.sort_values(["value", "item"], ascending=[False, True]).groupby("source", sort=False).head(top_terms)
        # a pair counts where its first source has the term, or lacks it and the second has it
        a, b = np.triu_indices(n, 1)
        block = g["block"].to_numpy()
        keep = (block[a] == x) & (block[b] == y)
        a, b = a[keep], b[keep]
        out = pd.DataFrame({"part": "pair", "source": names[a], "item": names[b], "value": pairs[a, b]})
        if len(terms):
            out = pd.concat([out, terms.assign(part="term")], ignore_index=True)
        return out.assign(lang=lang)[["lang", "part", "source", "item", "value"]]

    return run


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, max_cells: int = MAX_CELLS,
    source_block: int = SOURCE_BLOCK, task_cells: int = TASK_CELLS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for every source of a language the divergence of its
    term probabilities from those of each other source (part ``pair``, all ranks), and the terms it uses
    more than its language does (part ``term``, ranks to ``top_terms``).

    Null ``lang``, ``source`` and ``text`` are read as ''. A source without terms takes part with the
    smoothed probabilities of zero counts; a language without kept terms gives pairs of value 0, and one
    with a single source no pairs. Repeated rows and documents of one id count each; ids and further
    columns are ignored, whatever their names. Ties rank by the item's UTF-8 bytes. An empty table gives
    an empty result."""
    spark = docs.sparkSession
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = merged_stripes(src, min_docs, max_cells)
    cells = kept.select(
        "lang", "term", F.expr("aggregate(counts, 0L, (a, n) -> a + n)").alias("lang_count"), F.explode(F.arrays_zip("sources", "counts")).alias("c"),
    ).select("lang", "term", "lang_count", F.col("c.sources").alias("source"), F.col("c.counts").alias("count"))

    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("n_cells"))
    groups = src.select("lang", "source").distinct()
    groups = cut_lineage(groups.join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("n_cells", F.lit(0)).alias("n_cells")))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("n_cells").alias("lang_cells"), F.count(F.lit(1)).alias("n_sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms")), "lang", "left").select(
        "lang", "lang_total", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.ceil(F.col("n_sources") / source_block).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("lang_cells") / task_cells)).alias("shares"),
    )
    numbered = dense_positions(groups.select("lang", "source", "total"), ["lang"], ["source"], "no")
    groups = checked(numbered.join(checked(langs), "lang").withColumn("block", F.floor(F.col("no") / source_block)))

    # a block meets every block of its language, itself included
    meets = [
        F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
    ]
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt_cells = (
        cells.join(groups, ["lang", "source"])
        .select("lang", "term", "lang_count", "count", F.col("no").alias("source_no"), "block", F.pmod(F.xxhash64("term"), "shares").alias("share"), other)
        .select("lang", *meets, "share", "term", "lang_count", "count", "source_no")
    )
    dealt_groups = (
        groups.select("lang", "source", "no", "total", "lang_total", "n_terms", "block", "shares", other)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
        .select("lang", *meets, "share", "source", "no", "total", "lang_total", "n_terms", "block")
    )
    keys = ["lang", "x", "y", "share"]
    found = cut_lineage(dealt_cells.groupBy(*keys).cogroup(dealt_groups.groupBy(*keys)).applyInPandas(_emit(top_terms), EMITTED))

    half = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    half = half.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"), "value")
    order = [F.col("value").desc(), F.col("item")]
    pairs = half.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    terms = top_k(found.where("part = 'term'").select("lang", "source", "part", "item", "value"), ["lang", "source"], order, top_terms)
    return pairs.unionByName(terms.withColumn("rank", F.col("rank").cast("int")))
