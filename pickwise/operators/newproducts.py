"""New products: exposure, picks for a list, sampling, and promotion.

A3 shown_counts, A4/P6 promotion_list, J4 promoted_*, J5 remaining_*, C8 promote,
T3 top_rated_new, T4 least_shown_unrated, T5 sample_new, C3 new_product_recs.

Random choices of the original are replaced by hash order (``functions.hashing``): a
pick depends only on (seed, pool, category, user), so reruns and repartitioning give
the same lists. Pools are cut to a fixed size per category (4 and 2 rows), so joining
users to them never moves more than that per category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.config import DEFAULT, Config
from pickwise.functions.broadcast import Broadcaster, checked
from pickwise.functions.hashing import seeded
from pickwise.functions.sequence import dense_positions
from pickwise.functions.topk import top_k
from pickwise.operators.ratings import (
    PRODUCT_KEY, mean_ratings, new_means_from_stats, with_names,
)

USER = ["category", "user_id"]


# --- counts and promotion ---------------------------------------------------------------
def shown_counts(shown: DataFrame) -> DataFrame:
    """A3: exposures per new product name."""
    return shown.groupBy("category", "product_name").agg(F.count(F.lit(1)).alias("n_shown"))


def promotion_list(new_product_ratings: DataFrame, cfg: Config) -> DataFrame:
    """New products with more than ``promote_over`` ratings."""
    return (
        new_product_ratings.groupBy(*PRODUCT_KEY)
        .agg(F.count(F.lit(1)).alias("n_ratings"))
        .where(F.col("n_ratings") > cfg.promote_over)
    )


def promoted(df: DataFrame, plist: DataFrame) -> DataFrame:
    """Rows of ``df`` whose product is on the promotion list (left semi join)."""
    return df.join(plist.select(*PRODUCT_KEY), on=PRODUCT_KEY, how="left_semi")


def remaining(df: DataFrame, plist: DataFrame) -> DataFrame:
    """Rows of ``df`` whose product stays new (left anti join)."""
    return df.join(plist.select(*PRODUCT_KEY), on=PRODUCT_KEY, how="left_anti")


def promote(tables, cfg: Config) -> dict[str, DataFrame]:
    """The four tables after moving every promoted product and its ratings from the
    new tables to the established ones. Rows are conserved: nothing is lost or doubled.

    The list (one row per promoted product) is written once to the shared folder, so the
    four outputs join the same list without recounting the ratings four times, and it is
    broadcast when small enough: a product holding a large share of the ratings is then
    not sent to a single task by the semi/anti joins."""
    plist = checked(promotion_list(tables.new_product_ratings, cfg), cfg.broadcast_rows)
    return {
        "products": tables.products.unionByName(promoted(tables.new_products, plist)),
        "ratings": tables.ratings.unionByName(promoted(tables.new_product_ratings, plist)),
        "new_products": remaining(tables.new_products, plist),
        "new_product_ratings": remaining(tables.new_product_ratings, plist),
    }


# --- pools ----------------------------------------------------------------------------
def top_rated_new(new_product_ratings: DataFrame | None, new_products: DataFrame, k: int,
                  stats: DataFrame | None = None) -> DataFrame:
    """The k new products with the best mean rating per category (ties: lower id).
    Means come from the new-product ratings, or from ``product_stats`` when given."""
    means = new_means_from_stats(stats) if stats is not None else mean_ratings(new_product_ratings)
    return top_k(
        with_names(means, new_products), ["category"], [F.col("mean_rating").desc(), F.col("product_id")], k
    ).select("category", "rank", "product_id", "product_name", "mean_rating")


def least_shown_unrated(
    new_products: DataFrame, new_product_ratings: DataFrame | None, shown: DataFrame, k: int,
    stats: DataFrame | None = None,
) -> DataFrame:
    """T4: the k unrated new products shown least often (0 if never; ties: lower id)."""
    rated = (stats.where(F.col("n_new") > 0) if stats is not None else new_product_ratings)
    unrated = new_products.join(rated.select(*PRODUCT_KEY), on=PRODUCT_KEY, how="left_anti")
    counted = unrated.join(shown_counts(shown), on=["category", "product_name"], how="left")
    counted = counted.withColumn("n_shown", F.coalesce(F.col("n_shown"), F.lit(0)).cast("long"))
    return top_k(counted, ["category"], [F.col("n_shown"), F.col("product_id")], k).select(
        "category", "rank", "product_id", "product_name", "n_shown"
    )


def _cyclic_picks(
    users: DataFrame, pool: DataFrame, picks: int, salt: str, cfg: Config, slot0: int, source: str,
    bc: Broadcaster = checked,
) -> DataFrame:
    """``picks`` distinct pool entries per user: start at H(seed|salt|category|user) mod
    size and walk the pool's ``rank`` order cyclically. Empty pool: no rows.

    The pool carries its own size (a window over at most pool-size rows per category),
    so one small table serves both joins."""
    pool = bc(pool.select("category", "rank", "product_id", "product_name").withColumn(
        "_size", F.count(F.lit(1)).over(Window.partitionBy("category"))
    ))
    sizes = pool.where(F.col("rank") == 1).select("category", "_size")
    start = F.pmod(seeded(cfg.sample_seed, F.lit(salt), F.col("category"), F.col("user_id")),
                   F.col("_size"))
    steps = F.sequence(F.lit(0), F.least(F.lit(picks), F.col("_size")) - 1)
    walk = users.select(*USER).join(sizes, on="category", how="inner").select(
        *USER, "_size", start.alias("_start"), F.explode(steps).alias("_i")
    )
    walk = walk.withColumn("rank", (F.pmod(F.col("_start") + F.col("_i"), F.col("_size")) + 1)
                           .cast("long"))
    return walk.join(pool.drop("_size"), on=["category", "rank"], how="inner").select(
        *USER,
        (F.lit(slot0) + F.col("_i")).cast("long").alias("slot"),
        "product_id", "product_name", F.lit(source).alias("source"),
    )


def new_product_recs(users: DataFrame, tables, cfg: Config,
                     stats: DataFrame | None = None, bc: Broadcaster = checked) -> DataFrame:
    """Per user ``picks_per_pool`` products from the least-shown unrated pool, then
    as many from the best-rated pool (slots continue after the unrated picks)."""
    unrated = least_shown_unrated(
        tables.new_products, tables.new_product_ratings, tables.shown, cfg.unrated_pool, stats
    )
    rated = top_rated_new(tables.new_product_ratings, tables.new_products, cfg.rated_pool, stats)
    k = cfg.picks_per_pool
    return _cyclic_picks(users, unrated, k, "unrated", cfg, 0, "new_unrated", bc).unionByName(
        _cyclic_picks(users, rated, k, "rated", cfg, k, "new_rated", bc)
    )


def exposures(recs: DataFrame) -> DataFrame:
    """Rows to append to the shown list for every new product put in a list."""
    return recs.where(F.col("source").startswith("new_")).select("category", "product_name")


# --- sampling -------------------------------------------------------------------------
def hash_order(new_products: DataFrame, seed: int) -> DataFrame:
    """New products with their ``position`` 0..n-1 in the hash order of their category (distributed numbering)."""
    keyed = new_products.select(*PRODUCT_KEY, "product_name").withColumn(
        "_h", seeded(seed, F.col("category"), F.col("product_id"))
    )
    return dense_positions(keyed, ["category"], ["_h", "product_id"], "position").drop("_h")


def sample_new(users: DataFrame, new_products: DataFrame, cfg: Config,
               bc: Broadcaster = checked, order: DataFrame | None = None) -> DataFrame:
    """T5: ``n_recs`` distinct new products per user, without replacement.

    New products are placed in hash order per category; a user takes n_recs consecutive
    positions from a hash-chosen start, wrapping around. Cost is users x n_recs rows, not
    users x products. ``order`` is the stored ``hash_order`` under the default seed; without
    it, or under another seed, the order is made from ``new_products``.
    """
    k = cfg.n_recs
    if order is None or cfg.sample_seed != DEFAULT.sample_seed:
        order = hash_order(new_products, cfg.sample_seed)
    sizes = order.groupBy("category").agg((F.max("position") + 1).alias("_size"))
    start = F.pmod(seeded(cfg.sample_seed, F.col("category"), F.col("user_id")), F.col("_size"))
    walk = users.select(*USER).join(bc(sizes), on="category", how="inner").select(
        *USER, "_size", start.alias("_start"),
        F.explode(F.sequence(F.lit(0), F.least(F.lit(k), F.col("_size")) - 1)).alias("slot"),
    ).withColumn("position", F.pmod(F.col("_start") + F.col("slot"), F.col("_size")))
    return walk.join(order, on=["category", "position"], how="inner").select(
        *USER, F.col("slot").cast("long").alias("slot"), "product_id", "product_name",
        F.lit("sample").alias("source"),
    )
