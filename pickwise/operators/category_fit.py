"""ALS of one category in one task (M1, M3), for categories whose ratings and factors fit a task's memory.

Categories do not influence each other (see ``factorization``), so a category of bounded size needs no shuffle
between the halves of an iteration: its ratings stand packed in one row, a task reads them, runs all iterations
of a grid point and hands on the factors and the error on the category's validation rows. The caller counts first;
a category beyond the bound is fitted by Spark's ALS over the cluster.

The fit is that of Spark's ALS: factors are single precision, a row's system is summed and solved in double
precision, its regularisation is scaled by its number of ratings, and the first user factors are those that Spark's
ALS draws. A row with fewer ratings than factors is solved in its ratings instead (the same solution, a smaller
system). Rows of equal width are solved together; memory beyond the factors and two index lists is a chunk's.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.session import cut_lineage

# Python workers need not have this package installed: ship the functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 15  # factors that are gathered at once
WIDEST = 1 << 12  # ratings of a row beyond which its system is summed in slices
OUT_ROWS = 1 << 15  # factors of an Arrow batch

_BLOBS = ("users", "items", "tu", "ti", "tr", "vu", "vi", "vr")
FITTED = "side string, id int, features array<float>, category string, sse double, n long"
_FITTED = pa.schema([("side", pa.string()), ("id", pa.int32()), ("features", pa.list_(pa.float32())), ("category", pa.string()),
                     ("sse", pa.float64()), ("n", pa.int64())])


def task_bytes(n_ratings: int, n_users: int, n_items: int, ranks: tuple[int, ...]) -> int:
    """About what a task holds of a category: ratings in both orders, packed first factors, factors and their output."""
    return 40 * n_ratings + 4 * sum(set(ranks)) * n_users + 8 * max(ranks) * (n_users + n_items)


# --- packing: one row per category -------------------------------------------------------------
def _pack(ranks: tuple[int, ...]):
    """mapInArrow body: the rows of a partition, which are those of one category, as one row of arrays."""
    def run(batches: Iterator[pa.RecordBatch]):
        category, got = None, {k: [] for k in ("u", "i", "rating", "train")}
        ids, first = {r: [] for r in ranks}, {r: [] for r in ranks}
        for b in batches:
            if not b.num_rows:
                continue
            category = b.column("category")[0].as_py()
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            rated = b.filter(pa.array(rank == 0))
            for k in got:
                got[k].append(rated.column(k).to_numpy(zero_copy_only=False))
            for r in np.unique(rank[rank > 0]).tolist():
                drawn = b.filter(pa.array(rank == r))
                ids[r].append(drawn.column("u").to_numpy())
                first[r].append(drawn.column("features").flatten().to_numpy())
        if category is None:
            return
        u, i, rating, train = (np.concatenate(got[k]) for k in ("u", "i", "rating", "train"))
        u, i, rating, train = u.astype(np.int32), i.astype(np.int32), rating.astype(np.float64), train.astype(bool)
        order = np.lexsort((rating, i, u))  # sums do not depend on how rows arrive
        u, i, rating, train = u[order], i[order], rating[order], train[order]
        if not np.isfinite(rating[train]).all():
            raise ValueError("ratings must not be null, NaN or infinite")
        users, tu = np.unique(u[train], return_inverse=True)
        items, ti = np.unique(i[train], return_inverse=True)
        known = ~train & np.isin(u, users) & np.isin(i, items)  # the others have no factors
        arrays = {
            "users": users, "items": items, "tu": tu.astype(np.int32), "ti": ti.astype(np.int32), "tr": rating[train].astype(np.float32),
            "vu": np.searchsorted(users, u[known]).astype(np.int32), "vi": np.searchsorted(items, i[known]).astype(np.int32), "vr": rating[known]}
        for r in ranks:
            of = np.concatenate(ids[r]) if ids[r] else np.empty(0, np.int32)
            f = np.concatenate(first[r]).reshape(-1, r) if first[r] else np.empty((0, r), np.float32)
            order = np.argsort(of)
            if not np.array_equal(of[order], users):
                raise ValueError("the first factors are not those of the category's users")
            arrays[f"first_{r}"] = f[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array([category]), *(pa.array([a.tobytes()], pa.binary()) for a in arrays.values())], names=["category", *arrays])

    return run


@dataclass
class Packed:
    rows: DataFrame   # one row per category, in a partition of its own

    def fitted(self, rank: int, reg: float, iterations: int) -> DataFrame:
        """The factors (side, id, features) of all categories, and a row of side ``errors`` per category."""
        cols = ["category", *_BLOBS, f"first_{rank}"]
        return self.rows.select(*cols).mapInArrow(_fit_rows(rank, reg, iterations), FITTED)


def pack(data: DataFrame, categories: list[str], first: dict[int, DataFrame]) -> Packed:
    """``data``: category, u, i, rating, train (boolean). ``first``: the first factors (category, id, features) per rank."""
    cols = {"category": "string", "u": "int", "i": "int", "rating": "double", "train": "boolean", "rank": "int", "features": "array<float>"}
    shape = lambda d: d.select(*(F.col(c).cast(t) if c in d.columns else F.lit(None).cast(t).alias(c) for c, t in cols.items()))
    rows = shape(data.withColumn("rank", F.lit(0)))
    for r, f in first.items():
        rows = rows.unionByName(shape(f.withColumnRenamed("id", "u").withColumn("rank", F.lit(r))))
    cell = (F.array_position(F.array(*map(F.lit, categories)), F.col("category")) - 1).cast("int")
    rows = rows.withColumn("cell", cell).repartitionById(len(categories), "cell").drop("cell")
    blobs = [*_BLOBS, *(f"first_{r}" for r in first)]
    return Packed(cut_lineage(rows.mapInArrow(_pack(tuple(first)), "category string, " + ", ".join(f"{b} binary" for b in blobs))))


# --- one half of an iteration -----------------------------------------------------------------
def _solve(A, b):
    """Positive definite systems A (n, n, m) x = b (n, m) by elimination, in place; the last axis is the batch."""
    n = len(A)
    for j in range(n):
        if not (A[j, j] > 0).all():
            raise ValueError("a system of the fit is singular")
        f = A[j + 1:, j] / A[j, j]
        A[j + 1:, j + 1:] -= f[:, None] * A[j, None, j + 1:]
        b[j + 1:] -= f * b[j]
    for j in range(n - 1, -1, -1):
        b[j] -= (A[j, j + 1:] * b[j + 1:]).sum(axis=0)
        b[j] /= A[j, j]
    return b


def _widths(most: int, rank: int) -> np.ndarray:
    """Widths that rows are filled up to: every number up to the rank, then steps of an eighth."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] + (1 if out[-1] < rank else max(1, out[-1] // 8)))
    return np.minimum(out, most)


def _layout(rows, cols, rating, n_rows: int, n_cols: int, rank: int):
    """The ratings by row, rows of one width together: (rows, their columns, ratings, numbers of ratings). Rows are
    filled up with the column ``n_cols``, whose factor is zero. Wider rows follow, one by one."""
    order = np.argsort(rows, kind="stable")
    cols, rating = cols[order], rating[order]
    count = np.bincount(rows, minlength=n_rows)
    start = np.cumsum(count) - count
    widths = _widths(min(int(count.max(initial=1)), WIDEST), rank)
    of = np.searchsorted(widths, count)
    out = []
    for k in np.unique(of[count <= WIDEST]):
        who, w = np.flatnonzero((of == k) & (count <= WIDEST)), int(widths[k])
        at = start[who][:, None] + np.arange(w)
        there = np.arange(w) < count[who][:, None]
        at[~there] = 0
        out.append((who, np.where(there, cols[at], n_cols).astype(np.int32), np.where(there, rating[at], 0).astype(np.float32), count[who]))
    for who in np.flatnonzero(count > WIDEST):
        part = slice(start[who], start[who] + count[who])
        out.append((np.array([who]), cols[part][None], rating[part][None], count[who:who + 1]))
    return out


def _half(X, layout, n_rows: int, reg: float):
    """The factors of the rows, given those of the columns: X (columns + 1, rank), its last row zero. So is the result's."""
    rank = X.shape[1]
    Y = np.zeros((n_rows + 1, rank), np.float32)
    for who, idx, val, count in layout:
        k = idx.shape[1]
        step = max(1, CHUNK // k)
        for lo in range(0, len(who), step):
            s = slice(lo, lo + step)
            more = count[s] * reg
            if k > WIDEST:  # a row by itself
                A, b = np.zeros((rank, rank)), np.zeros(rank)
                for at in range(0, k, CHUNK):
                    V = X[idx[lo, at:at + CHUNK]].astype(np.float64)
                    A += V.T @ V
                    b += V.T @ val[lo, at:at + CHUNK]
                A, b = A[:, :, None], b[:, None]
            else:
                V, r = X[idx[s]].astype(np.float64), val[s].astype(np.float64)
                if k == 1:
                    V = V[:, 0]
                    Y[who[s]] = V * (r[:, 0] / ((V * V).sum(axis=1) + more))[:, None]
                    continue
                if k < rank:
                    A, b = np.matmul(V, V.transpose(0, 2, 1)), r.T.copy()
                else:
                    A, b = np.matmul(V.transpose(0, 2, 1), V), np.einsum("mkf,mk->fm", V, r)
                A = A.transpose(1, 2, 0).copy()
            d = np.arange(len(A))
            A[d, d] += more
            x = _solve(A, b)
            Y[who[s]] = np.einsum("mkf,km->mf", V, x) if k < rank else x.T
    return Y


def _errors(U, V, vu, vi, vr) -> float:
    """Sum of the squared errors; predictions are single precision, as Spark's are."""
    out = 0.0
    for lo in range(0, len(vu), CHUNK):
        s = slice(lo, lo + CHUNK)
        dot = np.einsum("mf,mf->m", U[vu[s]].astype(np.float64), V[vi[s]].astype(np.float64)).astype(np.float32)
        out += float(((vr[s] - dot) ** 2).sum())
    return out


def _fit_rows(rank: int, reg: float, iterations: int):
    """mapInArrow body: packed categories to their factors and errors at one grid point."""
    def part(side, ids, f):
        for lo in range(0, len(ids), OUT_ROWS):
            own = ids[lo:lo + OUT_ROWS]
            n = len(own)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * rank, rank, dtype=np.int32)), pa.array(f[lo:lo + n].ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([side] * n), pa.array(own, pa.int32()), lists, pa.nulls(n, pa.string()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64())],
                schema=_FITTED)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for j in range(b.num_rows):
                raw = lambda name, kind: np.frombuffer(b.column(name)[j].as_buffer(), kind)  # noqa: B023, E731
                users, items, tu, ti, vu, vi = (raw(k, np.int32) for k in ("users", "items", "tu", "ti", "vu", "vi"))
                tr, vr = raw("tr", np.float32), raw("vr", np.float64)
                zero = np.zeros((1, rank), np.float32)
                U = np.concatenate([raw(f"first_{rank}", np.float32).reshape(-1, rank), zero])
                V = np.zeros((len(items) + 1, rank), np.float32)
                by_item = _layout(ti, tu, tr, len(items), len(users), rank)
                by_user = _layout(tu, ti, tr, len(users), len(items), rank)
                for _ in range(iterations):
                    V = _half(U, by_item, len(items), reg)
                    U = _half(V, by_user, len(users), reg)
                if len(vu):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(["errors"]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.float32())), b.column("category").slice(j, 1),
                         pa.array([_errors(U, V, vu, vi, vr)]), pa.array([len(vu)], pa.int64())], schema=_FITTED)
                yield from part("users", users, U)
                yield from part("items", items, V)

    return run
