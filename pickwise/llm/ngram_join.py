"""Exact Jaccard self-join of documents on word n-gram sets, by vertical partitioning.

Equal sets are one class first. A class is then followed only as far as it can still have a
partner (``t`` is the threshold, ``n`` a set's size; a partner shares at least ``ceil(t n)``
n-grams):

1. **Sketch filter.** In hash order, the first ``n - ceil(t n) + l(n)`` n-grams of a set must
   contain ``l`` that another set shows as well. Every task ships these n-grams once per n-gram
   that is alone in a block of its rows, and once in all for an n-gram that is not, so a
   passage in every document costs a row a block. Counts per set come back, no pairs.
2. **Global order.** For the sets that remain, n-grams are ordered by (number of sets, hash), rare ones
   first; n-grams of one set are dropped, as they can't be shared. A set that keeps under
   ``ceil(t n)`` n-grams is out.
3. **Fragments.** The order is cut into ``fragments`` ranges of about equal weight. A set becomes one
   segment a fragment.
4. **Candidates.** Two similar sets share an n-gram of their prefixes in the global order. Sets are linked to one
   set per (prefix n-gram, size class), never to all others; the components of these links
   hold every similar pair.
5. **Counting.** Segments are grouped by component. The overlaps of the pairs inside are counted fragment by
   fragment, each on its own, and summed per pair. A component over ``block`` sets or
   ``block_grams`` n-grams is cut into blocks, pair of blocks by pair of blocks a group of its
   own. A group returns a spanning forest of its links.

The links' connected components, with their classes' documents, are the result.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import batch, shingle_set, task_count, text_bytes
from pickwise.llm.components import connected_components
from pickwise.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, PERCENT = 5, 80
FRAGMENTS, BLOCK, BLOCK_GRAMS = 8, 1024, 1_000_000
CHUNK_GRAMS = 1_000_000   # sketch n-grams that a task holds at once
BROADCAST_IDS = 2_000_000  # document ids sent to all tasks at most; beyond, a shuffled join

SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.int64())])
SKETCH = pa.schema([("gram", pa.int64()), ("sig", pa.int64()), ("hits", pa.int64())])
GRAMS = pa.schema([("sig", pa.int64()), ("n", pa.int64()), ("gram", pa.int64())])


def signature(s: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(s.tobytes()), np.int64)[0])


def least_overlap(n, percent: int):
    """n-grams that a set of ``n`` shares with any partner, at least."""
    return -(-percent * n // 100)


def sketch_hits(n, percent: int):
    """Shown n-grams that a set of ``n`` must share to have a partner (its smallest one decides)."""
    return max(1, least_overlap(n, percent) // 10)


def sketch_length(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + max(1, n // 10))


def _sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, shingle) for t in b.column(1).to_pylist()]
            yield batch(SETS, b.column(0), [len(s) for s in sets], [signature(s) if len(s) else None for s in sets])

    return src.mapInArrow(run, "doc_id long, n_shingles long, sig long")


def _sketch(docs: DataFrame, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``(gram, sig, hits)``: a shown n-gram (hits 0; sig null if two sets show it), or hits already counted (gram null)."""

    def flush(grams: list, sigs: list):
        g = np.concatenate(grams).view(np.int64)
        s = np.repeat(np.array(sigs, np.int64), [len(x) for x in grams])
        order = np.argsort(g, kind="stable")
        g, s = g[order], s[order]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[start, len(g)])
        alone, many = start[size == 1], start[size > 1]
        hit = s[np.repeat(size > 1, size)]
        sig, hits = np.unique(hit, return_counts=True)
        gram = pa.array(np.r_[g[alone], g[many], np.zeros(len(sig), np.int64)], mask=np.r_[np.zeros(len(start), bool), np.ones(len(sig), bool)])
        mask = np.r_[np.zeros(len(alone), bool), np.ones(len(many), bool), np.zeros(len(sig), bool)]
        yield batch(SKETCH, gram, pa.array(np.r_[s[alone], s[many], sig], mask=mask), np.r_[np.zeros(len(start), np.int64), hits])

    def run(batches):
        grams, sigs, held, seen = [], [], 0, set()
        for b in batches:
            for t in b.column(0).to_pylist():
                s = shingle_set(t, shingle)
                if not len(s):
                    continue
                sig = signature(s)
                if sig in seen:
                    continue  # a copy within the block
                seen.add(sig)
                grams.append(s[:sketch_length(len(s), percent)])
                sigs.append(sig)
                held += len(grams[-1])
                if held >= CHUNK_GRAMS:
                    yield from flush(grams, sigs)
                    grams, sigs, held, seen = [], [], 0, set()
        if grams:
            yield from flush(grams, sigs)

    return docs.select(text_bytes(text_col).alias("t")).mapInArrow(run, "gram long, sig long, hits long")


def _count_hits(batches):
    """``(sig, hits)``: a hit for every n-gram of a set that another set shows too."""
    g, s, out = [], [], []
    for b in batches:
        gram, sig, hits = b.column(0), b.column(1), b.column(2)
        done = np.asarray(gram.is_null())
        if done.any():
            out.append((sig.filter(pa.array(done)).to_numpy(zero_copy_only=False), hits.filter(pa.array(done)).to_numpy()))
        open_ = pa.array(~done)
        g.append(gram.filter(open_).to_numpy())
        sig = sig.filter(open_)
        s.append((sig.fill_null(0).to_numpy(), np.asarray(sig.is_null())))
    if g:
        g = np.concatenate(g)
        many = np.concatenate([x[1] for x in s])
        s = np.concatenate([x[0] for x in s])
        if len(g):
            order = np.lexsort((s, g))
            g, s, many = g[order], s[order], many[order]
            start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            size = np.diff(np.r_[start, len(g)])
            differ = np.r_[False, (s[1:] != s[:-1]) & (g[1:] == g[:-1])]
            shared = np.add.reduceat(differ.astype(np.int64), start) + np.add.reduceat(many.astype(np.int64), start) > 0
            hit = s[np.repeat(shared, size) & ~many]
            out.append((hit, np.ones(len(hit), np.int64)))
    for sig, hits in out:  # one row a hit; the aggregate above combines them before they travel
        yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(hits, pa.int64())], names=["sig", "hits"])


def _grams(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for t in b.column(0).to_pylist():
                s = shingle_set(t, shingle)
                if not len(s):
                    continue
                sig = signature(s)
                if sig in seen:
                    continue
                seen.add(sig)
                if len(seen) > 1_000_000:
                    seen.clear()
                yield batch(GRAMS, np.full(len(s), sig), np.full(len(s), len(s)), s.view(np.int64))

    return docs.select(text_bytes(text_col).alias("t")).mapInArrow(run, "sig long, n long, gram long")


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    low = np.arange(n)
    while True:
        m, new = np.minimum(low[i], low[j]), low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _overlaps(segments: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Partial overlaps of the sets ``rows`` with the sets ``cols`` in one fragment."""
    out = np.zeros((len(rows), len(cols)), np.float32)
    size = np.array([len(x) for x in segments])
    if not size.sum():
        return out
    gram, at = np.unique(np.concatenate(segments), return_inverse=True)
    owner = np.repeat(np.arange(len(segments)), size)
    both = np.flatnonzero(np.bincount(at, minlength=len(gram)) > 1)
    number = np.full(len(gram), -1)
    number[both] = np.arange(len(both))
    col = number[at]
    owner, col = owner[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    width = max(256, min(4096, 8_000_000 // max(1, len(segments))))
    edges = np.searchsorted(col, np.arange(0, len(both) + width, width))
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        if lo == hi:
            continue
        x = np.zeros((len(segments), min(width, len(both) - k * width)), np.float32)
        x[owner[lo:hi], col[lo:hi] - k * width] = 1
        out += x[rows] @ x[cols].T
    return out


def _links(pdf: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group: (set, smallest set reachable in the group) per linked set."""
    within = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
    sets = pdf[["sig", "n", "block"]].drop_duplicates("sig").sort_values(["n", "sig"], ignore_index=True)
    place = dict(zip(sets["sig"], range(len(sets))))
    n, sig = sets["n"].to_numpy(), sets["sig"].to_numpy()
    left = np.flatnonzero((sets["block"] == pdf["bi"].iloc[0]).to_numpy())
    right = left if within else np.flatnonzero((sets["block"] == pdf["bj"].iloc[0]).to_numpy())
    total = np.zeros((len(left), len(right)), np.float32)
    for _, part in pdf.groupby("fragment", sort=True):
        segments = [np.empty(0, np.int64)] * len(sets)
        for s, g in zip(part["sig"], part["grams"]):
            segments[place[s]] = np.asarray(g, np.int64)
        total += _overlaps(segments, left, right)
    o = np.rint(total).astype(np.int64)
    i, j = np.nonzero(100 * o >= percent * (n[left][:, None] + n[right][None, :] - o))
    i, j = left[i], right[j]
    if within:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return sig[:0], sig[:0]
    root = _forest(i, j, len(sets))
    at = np.flatnonzero(root != np.arange(len(sets)))
    return sig[at], sig[root[at]]


def _verify(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    got = [_links(part, percent) for _, part in pdf.groupby(["comp", "bi", "bj"], sort=False)]
    return pd.DataFrame({"a": np.concatenate([x[0] for x in got]), "b": np.concatenate([x[1] for x in got])})


def similar_sets(
    docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, fragments: int,
) -> DataFrame:
    """``(a, b)``: links between different sets, enough of them to connect all that are connected."""
    spark = docs.sparkSession
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    key = F.coalesce("gram", "sig")
    shown = _sketch(docs, text_col, shingle, percent).repartition(task_count(spark, int(0.3 * total), 1_500_000), key)
    hits = shown.mapInArrow(_count_hits, "sig long, hits long").groupBy("sig").agg(F.sum("hits").alias("hits"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n_shingles") * percent / 100) / 10))
    classes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"))
    open_ = cut_lineage(classes.join(hits, "sig").where(F.col("hits") >= least).select("doc_id").distinct())
    n_open = open_.count()
    few = F.broadcast(open_) if n_open <= BROADCAST_IDS else open_
    src = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"))
    src = src.join(few, F.col("__id").eqNullSafe(F.col("doc_id")), "left_semi")

    grams = _grams(src, "__t", shingle)
    df = grams.groupBy("gram").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    ordered = (
        grams.join(df, "gram").groupBy("sig").agg(F.max("n").alias("n"), F.array_sort(F.collect_set(F.struct("df", "gram"))).alias("grams"))
        .withColumn("least", F.ceil(F.col("n") * percent / 100).cast("int")).where(F.size("grams") >= F.col("least"))
    )
    ordered = cut_lineage(ordered.select("sig", "n", "least", F.col("grams.gram").alias("gram"), F.col("grams.df").alias("df")))

    # candidates: every set is tied to the first set of its (prefix n-gram, size class)
    prefix = F.slice("gram", F.lit(1), F.size("gram") - F.col("least") + 1)
    spread = math.log(100 / percent) * 1.05
    post = ordered.select("sig", F.floor(F.log("n") / spread).cast("int").alias("cls"), F.explode(prefix).alias("gram"))
    first = post.groupBy("gram", "cls").agg(F.min("sig").alias("head"))
    same = post.join(first, ["gram", "cls"]).where("sig <> head").select(F.col("sig").alias("a"), F.col("head").alias("b"))
    above = first.select("gram", (F.col("cls") - 1).alias("cls"), F.col("head").alias("b"))
    near = first.join(above, ["gram", "cls"]).select(F.col("head").alias("a"), "b")
    comp = connected_components(same.unionByName(near).distinct())

    # fragments: cut points of the global order, at equal shares of the n-grams
    place = lambda d, g: d + (g.cast("double") / float(1 << 64) + 0.5)
    keys = ordered.select(F.explode(F.arrays_zip("df", "gram")).alias("x")).select(place(F.col("x.df"), F.col("x.gram")).alias("k"))
    cuts = keys.agg(F.percentile_approx("k", [i / fragments for i in range(1, fragments)], 1000)).first()[0] or []

    inside = ordered.join(comp.withColumnRenamed("node", "sig"), "sig")
    sizes = inside.groupBy("component").agg(F.count("*").alias("c"), F.sum(F.size("gram")).alias("g"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("g") / BLOCK_GRAMS)).cast("int"))
    weight = inside.agg(F.sum(F.size("gram"))).first()[0] or 0
    buckets = task_count(spark, weight, BLOCK_GRAMS)
    placed = inside.join(sizes.select("component", "blocks"), "component").withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks").cast("long")).cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("bi", F.least("block", "o")).withColumn("bj", F.greatest("block", "o"))
    # the order stays sorted, so a fragment is a slice between two cuts
    def upto(cut: float):
        return F.size(F.filter(F.arrays_zip("df", "gram"), lambda x: place(x["df"], x["gram"]) <= F.lit(cut)))

    bounds = F.array(F.lit(0), *map(upto, cuts), F.size("gram"))
    segments = (
        placed.withColumn("bounds", bounds)
        .select("sig", "n", "block", "bi", "bj", F.col("component").alias("comp"), "gram", "bounds", F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))).alias("fragment"))
        .select(
            "sig", "n", "block", "bi", "bj", "comp", "fragment",
            F.slice("gram", F.element_at("bounds", F.col("fragment") + 1) + 1, F.element_at("bounds", F.col("fragment") + 2) - F.element_at("bounds", F.col("fragment") + 1)).alias("grams"),
        )
    )
    # small components share a group; a block pair of a large one is alone in its own
    group = F.when((F.col("bi") == 0) & (F.col("bj") == 0), F.pmod(F.xxhash64("comp"), F.lit(buckets))).otherwise(F.xxhash64("comp", "bi", "bj"))
    return segments.withColumn("grp", group).groupBy("grp").applyInPandas(lambda pdf: _verify(pdf, percent), "a long, b long")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, fragments: int = FRAGMENTS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    A document's set holds the distinct ``shingle``-word n-grams of its words (A-Z lowered, cut at
    ``[\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is the one n-gram. Two documents link if
    ``100 |a & b| >= percent |a | b|``; ``component_id`` is the smallest id reachable by links.
    Null, empty and blank texts have no n-grams and link with nothing, not even with each other. Repeated rows
    and equal texts link like any others. A null id gets the component of its text, and names
    none. Other columns are ignored; an empty table gives an empty result. N-grams and sets
    are told apart by 64-bit hashes."""
    sets = cut_lineage(_sets(docs, id_col, text_col, shingle))
    links = similar_sets(docs, sets, id_col, text_col, shingle, percent, fragments)
    comp = connected_components(links).withColumnRenamed("node", "sig")
    classes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("low")).join(comp, "sig", "left")
    classes = classes.withColumn("component", F.coalesce("component", "sig"))
    low = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    named = classes.select("sig", "component").join(low, "component").select("sig", "component_id")
    return sets.join(named, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
