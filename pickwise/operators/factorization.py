"""Matrix factorisation: split, RMSE, ALS grid search, top-k scoring.

One ALS fit serves every category at once. (category, id) pairs are mapped to dense
integer indexes, so the rating matrix is block-diagonal by category. In explicit ALS a
row's normal equation only involves that row's own ratings (and a regularisation scaled
by its own count), so categories do not influence each other: one fit per grid point
instead of one per grid point and category. The winner is chosen per category from
per-category validation RMSE (strict ``<`` in grid order: rank outer, reg inner).

Every fitted point writes its factors. A category whose ratings and factors fit a task is fitted in one task a point,
which also sums the errors of its validation rows (``category_fit``). Larger ones are fitted by Spark's ALS; the errors
of all points then come from one pass over the validation rows, which meet the factors of all points stacked in one
array per id.

Scoring stays inside a category, never materialises the user x product matrix as rows, and scores only
the products whose norm lets them into a user's list.
"""

from __future__ import annotations

import gc
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pickwise.config import Config
from pickwise.functions.broadcast import checked
from pickwise.functions.hashing import seeded
from pickwise.functions.sequence import dense_positions
from pickwise.functions.topk import top_k
from pickwise.operators import category_fit
from pickwise.operators.category_fit import Packed
from pickwise.session import cut_lineage, scratch_path, shared_dir

# The scoring functions below run in Python workers, which need not have this package
# installed: ship them by value (numpy and pandas are imported there by reference).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

USER = ["category", "user_id"]
ITEM = ["category", "product_id"]
INT_MAX = 2**31 - 1
TRAIN, VALIDATE = "train", "validate"


# --- T7: deterministic split ------------------------------------------------------------
def split_train_validate(ratings: DataFrame, cfg: Config) -> DataFrame:
    """Adds ``split``: train when H(seed|category|user|product) mod 1000 < 700.

    Depends only on the row's key, so it is stable under repartitioning and reruns, and
    repeated ratings of one (user, product) stay on the same side."""
    bucket = F.pmod(
        seeded(cfg.split_seed, F.col("category"), F.col("user_id"), F.col("product_id")),
        F.lit(cfg.split_buckets),
    )
    cut = int(round(cfg.train_fraction * cfg.split_buckets))
    return ratings.withColumn("split", F.when(bucket < cut, TRAIN).otherwise(VALIDATE))


# --- A9: RMSE ----------------------------------------------------------------------------
def rmse(scored: DataFrame, by: list[str] | None = None, label: str = "rating",
         prediction: str = "prediction", digits: int | None = 6) -> DataFrame:
    """sqrt(mean((label - prediction)^2)) per group, rounded for output (``digits`` None: not
    rounded, as the winner of a grid needs it); every scored row counts once."""
    by = ["category"] if by is None else by
    err = F.pow(F.col(label) - F.col(prediction), 2)
    value = F.sqrt(F.avg(err))
    return scored.groupBy(*by).agg(
        (value if digits is None else F.round(value, digits)).alias("rmse"), F.count(F.lit(1)).alias("n_scored")
    )


# --- integer ids for ALS ----------------------------------------------------------------
def dense_index(keys: DataFrame, key: list[str], out: str) -> DataFrame:
    """(key..., out INT) over the distinct keys, numbered in key order across the cluster."""
    distinct = keys.select(*key).distinct()
    idx = dense_positions(distinct, [], key, out)
    guard = F.when(F.col(out) > INT_MAX, F.raise_error(F.lit("too many ids for ALS")))
    return idx.withColumn(out, F.coalesce(guard.cast("long"), F.col(out)).cast("int"))


@dataclass
class Indexed:
    data: DataFrame        # category, user_id, product_id, rating, split, u, i
    users: DataFrame       # category, user_id, u
    items: DataFrame       # category, product_id, i


def index_ratings(ratings: DataFrame, cfg: Config) -> Indexed:
    """Ratings with their split and integer ids. The two id tables (one row per user and
    per product) stand in the shared folder once, written by the numbering: training, prediction
    and the mapping of factors back to (category, id) all read them."""
    users = dense_index(ratings, USER, "u")
    items = dense_index(ratings, ITEM, "i")
    return Indexed(join_index(ratings, users, items, cfg), users, items)


def join_index(ratings: DataFrame, users: DataFrame, items: DataFrame, cfg: Config) -> DataFrame:
    rows = split_train_validate(ratings.select(*USER, "product_id", "rating"), cfg)
    return rows.join(users, on=USER).join(items, on=ITEM)


# --- M1 / M2 -----------------------------------------------------------------------------
def blocks_for(n_ratings: int, parallelism: int, cfg: Config) -> int:
    """User and item blocks of a fit: enough for the cores and for blocks of a bounded size."""
    return cfg.als_blocks or max(1, parallelism, -(-n_ratings // cfg.als_block_ratings))


def iteration_bytes(n_ratings: int, rank: int) -> int:
    """About what one iteration shuffles: at most one factor per rating goes each way."""
    return 2 * n_ratings * (4 * rank + 16)


def checkpoint_every(n_ratings: int, rank: int, cfg: Config) -> int:
    """Iterations between checkpoints. ALS frees the shuffles of its iterations at a checkpoint and not before, so
    those of this many iterations are on disk at once. The factors do not depend on it."""
    return max(1, min(cfg.als_checkpoint_interval, cfg.als_shuffle_bytes // max(1, iteration_bytes(n_ratings, rank))))


def als(rank: int, reg: float, cfg: Config, blocks: int) -> ALS:
    return ALS(
        rank=rank, maxIter=cfg.max_iter, regParam=reg, userCol="u", itemCol="i",
        ratingCol="rating", coldStartStrategy="drop", seed=cfg.als_seed, implicitPrefs=False,
        checkpointInterval=cfg.als_checkpoint_interval, numUserBlocks=blocks, numItemBlocks=blocks,
    )


def fit(train: DataFrame | Packed, rank: int, reg: float, cfg: Config, blocks: int | None = None) -> ALSModel | DataFrame:
    """M1: explicit-feedback ALS on indexed training rows. ``blocks``: as ``blocks_for`` gives
    them, where the caller has counted the rows already (and set the checkpoint interval). Rows that are counted
    here are kept for the fit: the joins that index them run once. Packed categories are fitted in their tasks and
    give the rows of ``category_fit.FITTED``."""
    if isinstance(train, Packed):
        return train.fitted(rank, reg, cfg.max_iter)
    spark = train.sparkSession
    shared_dir(spark)  # ALS checkpoints its lineage there
    if blocks is not None:
        return als(rank, reg, cfg, blocks).fit(train)
    train = train.select("u", "i", "rating").persist()
    try:
        n = train.count()
        blocks = blocks_for(n, spark.sparkContext.defaultParallelism, cfg)
        cfg = cfg.with_(als_checkpoint_interval=checkpoint_every(n, rank, cfg))
        return als(rank, reg, cfg, blocks).fit(train)
    finally:
        train.unpersist()


def release(model: ALSModel) -> None:
    """Frees what a model that is used no more holds on disk: its cached factors and the checkpoint that ALS leaves.
    The checkpoints are found by the name that ALS gives them; those of the ratings' own lineage are not touched."""
    sc = model.userFactors.sparkSession.sparkContext
    todo, seen = [model.userFactors._jdf.javaRDD().rdd(), model.itemFactors._jdf.javaRDD().rdd()], set()
    while todo:
        rdd = todo.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        name = rdd.name() or ""
        if name in ("userFactors", "itemFactors"):
            rdd.unpersist(False)
        if name.startswith("itemFactors-"):
            if rdd.getCheckpointFile().isDefined():
                path = sc._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile().get())
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
            continue
        if name != "ratingBlocks":
            deps = rdd.dependencies()
            todo += [deps.apply(k).rdd() for k in range(deps.size())]


def predict(model: ALSModel, rows: DataFrame) -> DataFrame:
    """Predictions for indexed (u, i) rows; pairs without factors drop."""
    return model.transform(rows)


# --- M3: grid search -----------------------------------------------------------------------
@dataclass
class GridResult:
    grid: DataFrame                 # category, grid_index, rank, reg_param, rmse, n_scored, is_best
    winners: dict[str, int]         # category -> grid index
    run_path: str                   # factors of every point: <run_path>/point=<grid index>/fitted
    index: Indexed | None           # None where the categories were fitted in groups
    parts: tuple["GridResult", ...] = ()  # the groups, each with a run path of its own


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A marker of the run, or None if it was not written whole (a writer that dies leaves no row)."""
    try:
        found = spark.read.schema(schema).parquet(path)
        return None if found.isEmpty() else found
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


_MARK = "n_rows long, digest long"
_USER_INDEX, _ITEM_INDEX = "category string, user_id long, u int", "category string, product_id long, i int"


def _run_index(ratings: DataFrame, cfg: Config, run_path: str) -> Indexed:
    """The run's id tables: those of an earlier attempt on the same ratings, else new ones. Ratings other
    than those the run began with are refused."""
    spark = ratings.sparkSession
    row = F.xxhash64(*USER, "product_id", "rating")
    mark = tuple(ratings.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.shiftright(row, 16)), F.lit(0))).first())
    kept = _written(spark, f"{run_path}/begun", _MARK)
    if kept is None:
        ix = index_ratings(ratings, cfg)
        ix.users.write.mode("overwrite").parquet(f"{run_path}/index_users")
        ix.items.write.mode("overwrite").parquet(f"{run_path}/index_items")
        spark.createDataFrame([mark], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{run_path}/begun")
    elif tuple(kept.first()) != mark:
        raise ValueError(f"the run under {run_path} began with other ratings")
    users = spark.read.schema(_USER_INDEX).parquet(f"{run_path}/index_users")
    items = spark.read.schema(_ITEM_INDEX).parquet(f"{run_path}/index_items")
    return Indexed(join_index(ratings, users, items, cfg), users, items)


def fit_point(train: DataFrame | Packed, point: int, rank: int, reg: float, cfg: Config, blocks: int, run_path: str) -> None:
    """Fits one grid point and writes its factors; a point that was finished before is left as it is."""
    spark, path = (train.rows if isinstance(train, Packed) else train).sparkSession, f"{run_path}/point={point}"
    if _written(spark, f"{path}/done", "point int") is not None:
        return
    model = fit(train, rank, reg, cfg, blocks)
    if isinstance(model, ALSModel):
        side = lambda name, f: f.select(F.lit(name).alias("side"), "id", "features")
        side("users", model.userFactors).unionByName(side("items", model.itemFactors)).write.mode("overwrite").parquet(f"{path}/fitted")
        release(model)
    else:
        model.write.mode("overwrite").parquet(f"{path}/fitted")
    del model
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # Spark deletes the shuffle files of plans that the JVM holds no more
    spark.createDataFrame([(point,)], "point int").coalesce(1).write.mode("overwrite").parquet(f"{path}/done")


def point_factors(spark: SparkSession, run_path: str, point: int, side: str, key: str) -> DataFrame:
    """(key, features) of one side (users, items) of a fitted point."""
    rows = spark.read.schema(category_fit.FITTED).parquet(f"{run_path}/point={point}/fitted")
    return rows.where(F.col("side") == side).select(F.col("id").alias(key), "features")


def stacked_factors(spark: SparkSession, run_path: str, n_points: int, side: str, key: str) -> DataFrame:
    """(key, stack): the factors of all grid points, in grid order, in one array per id."""
    out = None
    for p in range(n_points):
        f = point_factors(spark, run_path, p, side, key).withColumn("p", F.lit(p))
        out = f if out is None else out.unionByName(f)
    by_point = F.array_sort(F.collect_list(F.struct("p", "features")))
    return out.groupBy(key).agg(F.flatten(F.transform(by_point, lambda x: x["features"])).alias("stack"))


def grid_errors(valid: DataFrame, users: DataFrame, items: DataFrame, ranks: list[int]) -> DataFrame:
    """(category, point, sse, n) of all grid points: every validation row meets the stacked factors of its user
    and of its product once; rows without factors drop. ``ranks``: the rank of every point."""
    cuts = np.concatenate([[0], np.cumsum(ranks)])[:-1]
    rows = valid.select("category", "rating", "u", "i").join(users, "u").join(items.withColumnRenamed("stack", "other"), "i")

    def errors(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            cats, rating = b.column(0).dictionary_encode(), b.column(1).to_numpy(zero_copy_only=False)
            u, v = (b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for c in (2, 3))
            dot = np.add.reduceat(u.astype(np.float64) * v, cuts, axis=1).astype(np.float32)
            err = (rating[:, None] - dot) ** 2
            code = cats.indices.to_numpy(zero_copy_only=False)
            for c, name in enumerate(cats.dictionary.to_pylist()):
                e = err[code == c]
                both = np.vstack([e.sum(axis=0), np.full(len(cuts), len(e), float)])
                sums[name] = sums[name] + both if name in sums else both
        for name, (sse, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(sse)), pa.array(range(len(sse)), pa.int32()), pa.array(sse), pa.array(n.astype(np.int64))],
                names=["category", "point", "sse", "n"])

    parts = rows.select("category", "rating", "stack", "other").mapInArrow(errors, "category string, point int, sse double, n long")
    return parts.groupBy("category", "point").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n"))


def pick_winners(errors: list[tuple[str, int, float]]) -> dict[str, int]:
    """Grid index of the smallest error per category; the first in grid order wins, NaN never does."""
    best: dict[str, tuple[float, int]] = {}
    for category, point, e in sorted(errors, key=lambda x: x[1]):
        if e is not None and not np.isnan(e) and (category not in best or e < best[category][0]):
            best[category] = (e, point)
    return {c: p for c, (_, p) in best.items()}


def category_groups(ratings: DataFrame, cfg: Config) -> list[list[str]]:
    """Categories of one fit each, packed in descending order of their ratings. A group of several categories has
    at most ``fit_ratings`` ratings, so it has no more users or products than ALS has ids; a category beyond that
    is a group of its own."""
    sizes = ratings.where("category is not null").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    groups: list[list[str]] = []
    held = 0
    for r in sizes.orderBy(F.desc("n"), "category").collect():  # one row per category
        if not groups or held + r["n"] > min(cfg.fit_ratings, INT_MAX):
            groups.append([])
            held = 0
        groups[-1].append(r["category"])
        held += r["n"]
    return groups


def fits_at_once(n_ratings: int, cfg: Config) -> int:
    """Grid points fitted at once: fewer than ``grid_parallelism`` where one iteration of each would shuffle more
    than ``als_shuffle_bytes``; such a fit fills the cluster by itself."""
    return max(1, min(cfg.grid_parallelism, cfg.als_shuffle_bytes // max(1, iteration_bytes(n_ratings, max(cfg.ranks)))))


def grid_search(ratings: DataFrame, cfg: Config, run_path: str | None = None) -> GridResult:
    """M3: fits every grid point and takes the point of the smallest validation error per category.

    Every fitted point writes its factors under ``run_path`` (a new shared folder by default): a job that died
    goes on from there and fits only the points that are missing. Errors of all points come from one pass over
    the validation rows. Categories whose ratings do not fit one fit are fitted in groups, one after the other;
    a group's result is that of a search over its categories alone."""
    run_path = run_path or scratch_path(ratings.sparkSession, "grid")
    groups = category_groups(ratings, cfg)
    if len(groups) < 2:
        return _search_group(ratings, cfg, run_path)
    parts = tuple(_search_group(ratings.where(F.col("category").isin(cats)), cfg, f"{run_path}/group={k}") for k, cats in enumerate(groups))
    grid = parts[0].grid
    for p in parts[1:]:
        grid = grid.unionByName(p.grid)
    return GridResult(grid, {c: point for p in parts for c, point in p.winners.items()}, run_path, None, parts)


def _search_group(ratings: DataFrame, cfg: Config, run_path: str) -> GridResult:
    """The grid search of one group of categories: those that fit a task each, and those that do not."""
    ix = _run_index(ratings, cfg, run_path)
    ix.data = ix.data.select("category", "rating", "split", "u", "i").persist()  # reused by every grid point
    try:
        count = lambda d: {r["category"]: r["count"] for r in d.groupBy("category").count().collect()}  # noqa: E731, one row per category
        sizes, users, items = count(ix.data), count(ix.users), count(ix.items)
        held = {c: category_fit.task_bytes(n, users[c], items[c], cfg.ranks) for c, n in sizes.items()}
        small = sorted(c for c in sizes if held[c] <= cfg.fit_task_bytes and min(cfg.reg_params) > 0)
        large = sorted(set(sizes) - set(small))
        if small and large:
            of = lambda cats: Indexed(ix.data.where(F.col("category").isin(cats)), ix.users, ix.items)
            parts = (_search_small(of(small), small, sum(sizes[c] for c in small), cfg, f"{run_path}/small"),
                     _search_large(of(large), sum(sizes[c] for c in large), cfg, f"{run_path}/large"))
            return GridResult(parts[0].grid.unionByName(parts[1].grid), parts[0].winners | parts[1].winners, run_path, None, parts)
        n = sum(sizes.values())
        return _search_small(ix, small, n, cfg, run_path) if small else _search_large(ix, n, cfg, run_path)
    finally:
        ix.data.unpersist()


def _points(cfg: Config) -> list[tuple[int, float]]:
    return [(r, g) for r in cfg.ranks for g in cfg.reg_params]


def first_factors(train: DataFrame, rank: int, cfg: Config, blocks: int) -> DataFrame:
    """(category, id, features): the user factors that ALS begins with. They follow from the users and the blocks alone,
    so ALS draws them from one row per user."""
    shared_dir(train.sparkSession)
    users = train.select("category", "u").distinct().persist()
    try:
        model = als(rank, 1.0, cfg.with_(max_iter=0), blocks).fit(users.select("u", F.lit(0).alias("i"), F.lit(1.0).alias("rating")))
        return cut_lineage(model.userFactors.join(users, F.col("id") == F.col("u")).select("category", "id", "features"))
    finally:
        users.unpersist()


def _search_small(ix: Indexed, categories: list[str], n: int, cfg: Config, run_path: str) -> GridResult:
    """Every category is fitted in one task a grid point; its ratings are packed once."""
    spark = ix.users.sparkSession
    grid = _points(cfg)
    blocks = blocks_for(n, spark.sparkContext.defaultParallelism, cfg)
    train = ix.data.where(F.col("split") == TRAIN)
    first = {r: first_factors(train, r, cfg, blocks) for r in sorted(set(cfg.ranks))}
    packed = category_fit.pack(ix.data.withColumn("train", F.col("split") == TRAIN), categories, first)
    with ThreadPoolExecutor(max_workers=max(1, cfg.grid_parallelism)) as pool:
        list(pool.map(lambda p: fit_point(packed, p[0], *p[1], cfg, blocks, run_path), enumerate(grid)))
    found = {}
    for p in range(len(grid)):
        rows = spark.read.schema(category_fit.FITTED).parquet(f"{run_path}/point={p}/fitted").where("side = 'errors'")
        found |= {(r["category"], p): (r["sse"], r["n"]) for r in rows.collect()}  # one row per category
    return _grid_result(spark, found, grid, run_path, ix)


def _search_large(ix: Indexed, n: int, cfg: Config, run_path: str) -> GridResult:
    """All categories in one fit of Spark's ALS a grid point."""
    spark = ix.users.sparkSession
    grid = _points(cfg)
    blocks = blocks_for(n, spark.sparkContext.defaultParallelism, cfg)
    train = ix.data.where(F.col("split") == TRAIN)
    each = lambda rank: cfg.with_(als_checkpoint_interval=checkpoint_every(n, rank, cfg))
    with ThreadPoolExecutor(max_workers=fits_at_once(n, cfg)) as pool:
        list(pool.map(lambda p: fit_point(train, p[0], *p[1], each(p[1][0]), blocks, run_path), enumerate(grid)))

    users = stacked_factors(spark, run_path, len(grid), "users", "u")
    items = stacked_factors(spark, run_path, len(grid), "items", "i")
    valid = ix.data.where(F.col("split") == VALIDATE)
    # one row per category and grid point
    found = {(r["category"], r["point"]): (r["sse"], r["n"]) for r in grid_errors(valid, users, items, [r for r, _ in grid]).collect()}
    return _grid_result(spark, found, grid, run_path, ix)


def _grid_result(spark: SparkSession, found: dict[tuple[str, int], tuple[float, int]], grid: list[tuple[int, float]], run_path: str, ix: Indexed) -> GridResult:
    rmses = {k: float(np.sqrt(sse / n)) for k, (sse, n) in found.items()}
    winners = pick_winners([(c, p, e) for (c, p), e in rmses.items()])
    rows = [
        (c, p, grid[p][0], float(grid[p][1]), None if np.isnan(e) else round(e, 6), int(found[c, p][1]), winners.get(c) == p)
        for (c, p), e in sorted(rmses.items())
    ]
    table = spark.createDataFrame(rows, "category string, grid_index int, rank int, reg_param double, rmse double, n_scored long, is_best boolean")
    return GridResult(table, winners, run_path, ix)


def winning_factors(res: GridResult) -> tuple[DataFrame, DataFrame]:
    """Category-scoped factor tables of the per-category winners:
    (category, user_id, features) and (category, product_id, features)."""
    if res.parts:
        users, items = winning_factors(res.parts[0])
        for u, i in map(winning_factors, res.parts[1:]):
            users, items = users.unionByName(u), items.unionByName(i)
        return users, items
    spark = res.grid.sparkSession
    users = spark.createDataFrame([], "category string, user_id long, features array<float>")
    items = spark.createDataFrame([], "category string, product_id long, features array<float>")
    for point in sorted(set(res.winners.values())):
        # built from the driver-held winner list: at most one row per category
        cats = F.broadcast(spark.createDataFrame([(c,) for c, p in sorted(res.winners.items()) if p == point], "category string"))
        read = lambda side, key: point_factors(spark, res.run_path, point, side, key)  # noqa: B023, E731
        users = users.unionByName(read("users", "u").join(res.index.users, "u").join(cats, "category", "left_semi").select(*USER, "features"))
        items = items.unionByName(read("items", "i").join(res.index.items, "i").join(cats, "category", "left_semi").select(*ITEM, "features"))
    return users, items


# --- M5: pruned exact top-k ------------------------------------------------------------------
# A score is at most the product of the two norms. Items stand in descending order of their norm, so
# once that bound falls below a user's running k-th score, no later item can enter the user's list.
TILE_USERS, FIRST_ITEMS, TILE_ITEMS = 256, 512, 4096
SLACK = 1e-12  # relative; far above the rounding of a dot product of a few dozen factors


def _exact(U, V):
    """Row-wise dot products, summed factor by factor: one value for a pair however it was found."""
    s = np.zeros(len(U))
    for f in range(U.shape[1]):
        s += U[:, f] * V[:, f]
    return s


def _norms(V):
    return np.sqrt((V * V).sum(axis=1)) if len(V) else np.zeros(0)


def _by_norm(iids, V):
    """(ids, factors, norms) in descending order of norm."""
    norms = _norms(V)
    order = np.lexsort((iids, -norms))
    return iids[order], V[order], norms[order]


def _nothing(n, k):
    """Lists of ``n`` users that hold no item yet."""
    return np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), -np.inf)


def _search(U, iids, V, norms, k, floor=None, best=None):
    """(ids, scores, number of items scored) of the k best items of every user, ties to the lower id; free places
    have the score -inf. ``floor``: a score per user below which no item matters. ``best``: lists found among other
    items, which are taken over and brought up to date in place."""
    n, size = len(U), _norms(U)
    best_i, best_s = _nothing(n, k) if best is None else best
    floor = np.full(n, -np.inf) if floor is None else floor
    scored, at = np.zeros(n, np.int64), 0
    while at < len(iids):
        kth = np.maximum(best_s[:, -1], floor)
        reach = size * norms[at]
        act = np.flatnonzero(reach * (1 + SLACK) >= kth)
        if not len(act):
            break
        tile = V[at:at + (TILE_ITEMS if at else FIRST_ITEMS)]
        scored[act] += len(tile)
        s = U[act] @ tile.T  # picks candidates; their scores are summed anew below
        low = kth[act]
        if len(tile) > k:
            free = np.isneginf(low)
            low[free] = np.partition(s[free], len(tile) - k, axis=1)[:, len(tile) - k]
        row, col = np.nonzero(s >= (low - 2 * SLACK * reach[act])[:, None])
        got, ids = _exact(U[act[row]], tile[col]), iids[at + col]
        enters = (got > best_s[act[row], -1]) | ((got == best_s[act[row], -1]) & (ids < best_i[act[row], -1]))
        row, got, ids = row[enters], got[enters], ids[enters]
        row = np.concatenate([np.repeat(np.arange(len(act)), k), row])
        got, ids = np.concatenate([best_s[act].ravel(), got]), np.concatenate([best_i[act].ravel(), ids])
        order = np.lexsort((ids, -got, row))
        pick = order[np.searchsorted(row[order], np.arange(len(act)))[:, None] + np.arange(k)]
        best_s[act], best_i[act] = got[pick], ids[pick]
        at += len(tile)
    return best_i, best_s, scored


def _topk_pruned(uids, U, iids, V, norms, k, floor=None):
    """(user, item, score, rank, items scored for the user) rows, users in tiles: memory is bounded by a tile."""
    out = []
    for lo in range(0, len(uids), TILE_USERS):
        part = slice(lo, lo + TILE_USERS)
        ids, s, scored = _search(U[part], iids, V, norms, k, None if floor is None else floor[part])
        row, place = np.nonzero(~np.isneginf(s))
        out.append((uids[part][row], ids[row, place], s[row, place], place + 1, scored[row]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _topk_rows(uids, U, iids, V, k: int):
    """Exact top-k of every user over the items, ties to the lower item id."""
    return _topk_pruned(uids, U, *_by_norm(iids, V), k)[:4]


SCORED = "category string, user_id long, product_id long, score double, rank long, n_scored long"
_SCORED = pa.schema([("category", pa.string()), ("user_id", pa.int64()), ("product_id", pa.int64()), ("score", pa.float64()),
                     ("rank", pa.int64()), ("n_scored", pa.int64())])


def _frame(cat, u, i, v, r, n) -> pd.DataFrame:
    return pd.DataFrame({"category": np.full(len(u), cat, dtype=object), "user_id": u, "product_id": i, "score": v,
                         "rank": r.astype(np.int64), "n_scored": n})


def _item_matrices(item_factors: DataFrame) -> dict:
    """Item factors per category as numpy arrays in descending order of norm, row by row from the cluster;
    callers check the size first."""
    ids: dict[str, list] = {}
    feats: dict[str, list] = {}
    for r in item_factors.select("category", "product_id", "features").toLocalIterator():
        ids.setdefault(r["category"], []).append(r["product_id"])
        feats.setdefault(r["category"], []).append(np.asarray(r["features"], np.float32))
    return {c: _by_norm(np.array(ids[c], np.int64), np.stack(feats[c]).astype(np.float64)) for c in ids}


def _score_users(items, k: int):
    """mapInPandas body for user factor rows against broadcast item matrices."""
    def score(batches):
        mats = items.value
        for pdf in batches:
            for cat, g in pdf.groupby("category"):
                if cat in mats:
                    yield _frame(cat, *_topk_pruned(
                        g["user_id"].to_numpy(np.int64), np.stack(g["features"].to_numpy()).astype(np.float64), *mats[cat], k))

    return score


def _packed(blocks: DataFrame, width: str) -> DataFrame:
    """Blocks whose rows, an array of structs, become one binary column: the struct's fields one after the other, the
    factors last. ``width``: name of the array column; the number of its rows stands beside it as ``n_<width>``."""
    keep = [c for c in blocks.columns if c != width]
    schema = T.StructType([blocks.schema[c] for c in keep] + [T.StructField(f"n_{width}", T.LongType()), T.StructField(width, T.BinaryType())])

    def run(batches):
        for b in batches:
            rows, n, raw = b.column(len(keep)), [], []
            for k in range(b.num_rows):
                fields = rows[k].values.flatten()
                n.append(len(fields[0]))
                fields = [*fields[:-1], fields[-1].flatten()]
                raw.append(b"".join(f.to_numpy().tobytes() for f in fields))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array(n, pa.int64()), pa.array(raw, pa.binary())], names=[*keep, f"n_{width}", width])

    return blocks.select(*keep, width).mapInArrow(run, schema)


def _matrix(raw: bytes, at: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32, offset=at).reshape(n, -1).astype(np.float64)


class _UserBlock:
    """The running lists of one user block while item blocks are met one by one."""

    def __init__(self, category: str, n: int, raw: bytes, k: int):
        self.category, self.k, self.raw = category, k, raw
        self.ids, self.floor, self.reach = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.float64, n, 8 * n), np.frombuffer(raw, np.int64, n, 16 * n)
        self.U = _matrix(raw, 24 * n, n)
        self.best_i, self.best_s = _nothing(n, k)

    def meet(self, blk: int, n: int, raw: bytes) -> None:
        """Users that reach the block are scored against its items."""
        mine = np.flatnonzero(self.reach >= blk)
        items = _by_norm(np.frombuffer(raw, np.int64, n), _matrix(raw, 8 * n, n))
        tile = max(TILE_USERS, TILE_USERS * TILE_ITEMS // max(1, n))
        for lo in range(0, len(mine), tile):
            part = mine[lo:lo + tile]
            best = self.best_i[part], self.best_s[part]
            _search(self.U[part], *items, self.k, self.floor[part], best)
            self.best_i[part], self.best_s[part] = best

    def lists(self) -> pd.DataFrame:
        row, place = np.nonzero(~np.isneginf(self.best_s))
        return _frame(self.category, self.ids[row], self.best_i[row, place], self.best_s[row, place], place + 1, np.zeros(len(row), np.int64))


def _score_blocks(k: int):
    """mapInArrow body for block pairs. Pairs of one user block follow each other: its lists are kept over them and
    handed on once, k rows a user. (Where they do not, more lists of a user come out, and are merged later.)"""
    def score(batches):
        now, key = None, None
        for b in batches:
            cats, parts, blks, n_users, users, n_items, items = b.columns
            for j in range(b.num_rows):
                mine = cats[j].as_py(), parts[j].as_py()
                if mine != key:
                    if now is not None:
                        yield pa.RecordBatch.from_pandas(now.lists(), _SCORED, preserve_index=False)
                    now, key = _UserBlock(mine[0], n_users[j].as_py(), users[j].as_py(), k), mine
                now.meet(blks[j].as_py(), n_items[j].as_py(), items[j].as_py())
        if now is not None:
            yield pa.RecordBatch.from_pandas(now.lists(), _SCORED, preserve_index=False)

    return score


def _norm_col(features: str) -> F.Column:
    squares = F.transform(features, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))


SLAB_ITEMS = 1 << 19  # items of the blocks that a task holds at once
LANES_PER_CORE = 4


def _meet(user_blocks: DataFrame, item_blocks: DataFrame, k: int) -> DataFrame:
    """Scores of the pairs of a user block with the item blocks of its category up to its own ``blk``.

    Pairs are formed in cells. User blocks are dealt over ``lane``s, each category by its share, so a category is not
    one task; item blocks stand in slabs of bounded size. A user block goes to its lane once for every slab it reaches,
    an item block once to every lane: what is shuffled follows the users and the items, not their pairs."""
    cells = LANES_PER_CORE * user_blocks.sparkSession.sparkContext.defaultParallelism
    n = checked(user_blocks.groupBy("category").agg(F.count(F.lit(1)).alias("_n")))
    total = n.agg(F.sum("_n").alias("_all"))
    lanes = checked(n.crossJoin(F.broadcast(total)).select("category", F.ceil(F.least("_n", F.col("_n") * cells / F.col("_all"))).alias("lanes")))
    left = user_blocks.join(lanes, "category").withColumn("lane", F.pmod(F.xxhash64("part"), "lanes")).drop("lanes")
    left = left.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), "slab")))
    right = item_blocks.join(lanes, "category").withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)))
    cell = ["category", "lane", "slab"]
    left = left.repartition(cells, *cell).withColumnRenamed("blk", "last")
    right = right.select(*cell, "blk", "n_items", "items").repartition(cells, *cell).sortWithinPartitions(*cell, "blk")
    pairs = left.join(right, cell).where("blk <= last")
    return pairs.select("category", "part", "blk", "n_users", "users", "n_items", "items").mapInArrow(_score_blocks(k), SCORED)


def _block_bounds(blocks: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per category the blocks' largest norms, in descending order, and how many items they hold up to each: two numbers
    a block of hundreds of items or more."""
    t = blocks.select("category", "blk", "bound", "n").where("category is not null").toArrow().to_pandas().sort_values("blk")
    return {c: (g["bound"].to_numpy(np.float64), g["n"].to_numpy(np.int64).cumsum()) for c, g in t.groupby("category")}


_REACHED = "category string, user_id long, features array<float>, floor double, reach long, n_scored long"


def _reaches(bounds):
    """mapInArrow body: users (category, user_id, features, norm, floor) with the last block that they reach, found by
    bisection, and the items up to it. A user row carries no block's bound: users of categories without items drop."""
    def run(batches):
        of = bounds.value
        for b in batches:
            category, norm, floor = b.column("category"), b.column("norm").to_numpy(zero_copy_only=False), b.column("floor").to_numpy(zero_copy_only=False)
            names = category.dictionary_encode()
            code = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            reach, scored, known = np.zeros(len(norm), np.int64), np.zeros(len(norm), np.int64), np.zeros(len(norm), bool)
            for c, name in enumerate(names.dictionary.to_pylist()):
                if name not in of:
                    continue
                at = np.flatnonzero(code == c)
                bound, upto = of[name]
                low, high = np.zeros(len(at), np.int64), np.full(len(at), len(bound) - 1)
                while (low < high).any():
                    mid = (low + high + 1) // 2
                    meets = bound[mid] * norm[at] * (1 + SLACK) >= floor[at]
                    low, high = np.where(meets, mid, low), np.where(meets, high, mid - 1)
                reach[at], scored[at], known[at] = low, upto[low], True
            got = pa.RecordBatch.from_arrays(
                [category, b.column("user_id"), b.column("features"), b.column("floor"), pa.array(reach), pa.array(scored)],
                names=["category", "user_id", "features", "floor", "reach", "n_scored"])
            yield got.filter(pa.array(known))

    return run


def block_join_top_k(user_factors: DataFrame, item_factors: DataFrame, k: int, cfg: Config) -> DataFrame:
    """M5 for items too many to broadcast, in two rounds of block pairs.

    Items are numbered per category by descending norm and cut into blocks. In the first round every user meets
    the block of the largest norms; its k-th score there tells how many further blocks the user reaches. In the
    second round users are packed with others of equal reach, and a user block meets the blocks it reaches, and
    no others."""
    size = cfg.score_block_rows
    slab = max(1, SLAB_ITEMS // size)  # blocks of a slab
    items = item_factors.select("category", "product_id", "features").withColumn("norm", _norm_col("features"))
    items = dense_positions(items.withColumn("down", -F.col("norm")), ["category"], ["down", "product_id"], "pos")
    blocks = items.withColumn("blk", F.floor(F.col("pos") / size)).groupBy("category", "blk").agg(
        F.collect_list(F.struct(F.col("product_id").alias("id"), "features")).alias("items"),
        F.max("norm").alias("bound"), F.count(F.lit(1)).alias("n"))
    blocks = cut_lineage(_packed(blocks, "items").withColumn("slab", F.floor(F.col("blk") / slab)))
    bounds = user_factors.sparkSession.sparkContext.broadcast(_block_bounds(blocks))

    user = F.struct(F.col("user_id").alias("id"), "floor", "reach", "features")
    users = user_factors.select("category", "user_id", "features").withColumn("norm", _norm_col("features"))
    counts = checked(users.groupBy("category").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts")))
    first = (
        users.join(counts, "category").withColumn("part", F.pmod(F.xxhash64("user_id"), "parts"))
        .withColumn("floor", F.lit(float("-inf"))).withColumn("reach", F.lit(0).cast("long"))
        .groupBy("category", "part").agg(F.collect_list(user).alias("users"))
        .withColumn("blk", F.lit(0).cast("long")).withColumn("slab", F.lit(0).cast("long"))
    )
    near = cut_lineage(_meet(cut_lineage(_packed(first, "users")), blocks.where("blk = 0"), k))
    kth = near.where(F.col("rank") == k).select(*USER, F.col("score").alias("floor"))
    users = users.join(kth, USER, "left").select(*USER, "features", "norm", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    users = cut_lineage(users.mapInArrow(_reaches(bounds), _REACHED))

    far = dense_positions(users.where("reach > 0").drop("n_scored"), ["category"], ["reach", "user_id"], "pos")
    far = far.withColumn("part", F.floor(F.col("pos") / size)).groupBy("category", "part").agg(F.collect_list(user).alias("users"), F.max("reach").alias("blk"))
    far = cut_lineage(_packed(far.withColumn("slab", F.floor(F.col("blk") / slab)), "users"))
    cand = near.unionByName(_meet(far, blocks.where("blk > 0"), k)).drop("rank", "n_scored")
    best = top_k(cand, USER, [F.col("score").desc(), F.col("product_id")], k)
    return best.join(users.select(*USER, "n_scored"), USER)


def recommend_top_k(user_factors: DataFrame, item_factors: DataFrame, k: int, cfg: Config, work: bool = False) -> DataFrame:
    """M5: the k best products of the user's own category for every user with factors:
    (category, user_id, product_id, score, rank); ties go to the lower product id. With ``work`` also
    ``n_scored``, the number of products that were scored for the user.

    Products are met in descending order of their norm, and a user stops when the norms' product falls
    below the running k-th score. Item factors under ``score_broadcast_bytes`` (counted first) are broadcast as numpy
    matrices and users are scored where they are, nothing shuffled; beyond it see ``block_join_top_k``. Both run
    one kernel, whose memory is bounded by a constant and whose scores do not depend on the tiling.
    """
    n_items, width = item_factors.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    if (n_items or 0) * ((width or 0) * 8 + 16) <= cfg.score_broadcast_bytes:
        items = user_factors.sparkSession.sparkContext.broadcast(_item_matrices(item_factors))
        out = user_factors.select("category", "user_id", "features").mapInPandas(_score_users(items, k), SCORED)
    else:
        out = block_join_top_k(user_factors, item_factors, k, cfg)
    return out.select(*USER, "product_id", "score", "rank", *(["n_scored"] if work else []))


def scoring_work(scored: DataFrame, item_factors: DataFrame) -> DataFrame:
    """(category, n_users, n_items, n_scored, share): the part of all user and product pairs that a result of
    ``recommend_top_k(..., work=True)`` scored."""
    users = scored.groupBy(*USER).agg(F.max("n_scored").alias("n")).groupBy("category").agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_scored"))
    items = item_factors.groupBy("category").agg(F.count(F.lit(1)).alias("n_items"))
    return users.join(items, "category").select(
        "category", "n_users", "n_items", "n_scored", (F.col("n_scored") / (F.col("n_users") * F.col("n_items"))).alias("share"))


def user_recommendations(ratings: DataFrame, cfg: Config) -> tuple[DataFrame, GridResult]:
    """M4 + M5: grid search, then the top ``n_recs - n_new`` per rater with factors.
    Returns rows for ``user_recommendation_data`` and the grid result."""
    res = grid_search(ratings, cfg)
    uf, itf = winning_factors(res)
    recs = recommend_top_k(uf, itf, cfg.n_established, cfg).select(
        *USER, "product_id", "score"
    )
    return recs, res
