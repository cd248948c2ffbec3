"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosine
check, connected components.

Equal vectors of one label are one class first. A class gets one sign code a table; classes
of one label whose codes agree in a table meet in a bucket and are compared exactly, in
float64. A pair that met in an earlier table is skipped, so every link is counted once
without a table of pairs: a bucket returns link counts per class and a spanning forest of
its links. A bucket over ``block`` classes is compared in blocks, pair of blocks by pair of
blocks, each a group of its own, so no task holds more than two blocks.

Bits follow the largest label (buckets of about ``bucket`` classes for vectors in all
directions) and tables follow the bits, so that a pair exactly at the threshold meets in one
of the tables with probability ``recall`` or more; a closer pair more often still.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.components import connected_components
from pickwise.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table_plan(n: int, threshold: float, recall: float, bucket: int) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors of one label."""
    bits = min(24, max(1, math.ceil(math.log2(max(2, n / bucket)))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def unit_rows(vectors: list) -> np.ndarray:
    """Float64 rows of length one. Scaled by the largest component first: no overflow."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(seed: int, bits: int, tables: int):
    def run(frames):
        planes: dict[int, np.ndarray] = {}
        for pdf in frames:
            out = np.empty(len(pdf), object)
            dims = pdf["vec"].map(len).to_numpy()
            for d in np.unique(dims):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), bits * tables))
                at = np.flatnonzero(dims == d)
                sign = (unit_rows([pdf["vec"].iloc[i] for i in at]) @ planes[d] > 0).reshape(len(at), tables, bits)
                code = sign @ (1 << np.arange(bits, dtype=np.int64))
                for i, c in zip(at, code):
                    out[i] = c
            yield pdf.assign(codes=out)

    return run


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of every index over the links (i, j)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one block, or between the two blocks, of one bucket."""
    t, within = int(pdf["t"].iloc[0]), pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
    pdf = pdf.sort_values("key", ignore_index=True)
    x, codes, weight = unit_rows(list(pdf["vec"])), np.stack(list(pdf["codes"])), pdf["size"].to_numpy()
    left = np.flatnonzero((pdf["block"] == pdf["bi"]).to_numpy())
    right = left if within else np.flatnonzero((pdf["block"] == pdf["bj"]).to_numpy())
    found = []
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        a, b = np.nonzero(x[rows] @ x[right].T >= threshold)
        a, b = rows[a], right[b]
        if within:
            a, b = a[a < b], b[a < b]
        if t and len(a):
            new = ~(codes[a, :t] == codes[b, :t]).any(axis=1)
            a, b = a[new], b[new]
        found.append((a, b))
    a, b = (np.concatenate(z) for z in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))
    if not len(a):
        return pd.DataFrame({"key": [], "links": [], "a": [], "b": []}).astype({"key": str, "links": "int64", "a": "Int64", "b": "Int64"})
    links = np.bincount(a, weight[b], len(x)) + np.bincount(b, weight[a], len(x))
    root, rep = _forest(a, b, len(x)), pdf["rep"].to_numpy()
    at = np.flatnonzero(links)
    return pd.DataFrame({"key": pdf["key"].to_numpy()[at], "links": links[at].astype("int64"), "a": rep[at], "b": rep[root[at]]})


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.93, recall: float = 0.999, bucket: int = 512, block: int = 1024, seed: int = 7,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Two rows link if their labels are equal and not null, their vectors have the same length
    and their cosine is at least ``threshold``. Null, empty and zero vectors and vectors with a
    null or non-finite component link with nothing. Equal vectors link like any others.
    ``component_id`` is the smallest id reachable by links; rows that repeat an id are rows of
    their own. Null ids never name a component of others. Other columns are ignored; an empty
    table gives an empty result."""
    v = F.col(vec_col)
    fine = (
        F.col(label_col).isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    key = F.when(fine, F.md5(F.concat_ws(",", F.col(label_col).cast("string"), F.concat_ws(",", F.transform(v, lambda x: x.cast("string"))))))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("vec"), key.alias("key"))
    classes = cut_lineage(
        rows.where("key is not null and vec_id is not null").groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_plan(largest, threshold, recall, bucket)
    coded = classes.select("key", "rep", "size", F.col("label").cast("string").alias("label"), "vec").mapInPandas(
        _codes(seed, bits, tables), "key string, rep long, size long, label string, vec array<double>, codes array<long>"
    )
    coded = cut_lineage(coded)
    spot = ["label", "d", "t", "code"]
    met = coded.select("key", "label", F.size("vec").alias("d"), F.posexplode("codes").alias("t", "code"))
    full = met.groupBy(*spot).count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count")
    placed = met.join(full, spot).withColumn("block", F.pmod(F.xxhash64("key", "t"), F.col("blocks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("key", *spot, "block", other.alias("o")).select(
        "key", *spot, "block", F.least("block", "o").alias("bi"), F.greatest("block", "o").alias("bj")
    )
    body = coded.select("key", "rep", "size", "vec", "codes")
    found = cut_lineage(
        placed.join(body, "key").groupBy(*spot, "bi", "bj")
        .applyInPandas(lambda pdf: _compare(pdf, threshold), "key string, links long, a long, b long")
    )
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    comp = connected_components(found)
    of_class = (
        classes.select("key", "rep", "size").join(links, "key", "left")
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    out = rows.select("vec_id", "key").join(of_class, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
