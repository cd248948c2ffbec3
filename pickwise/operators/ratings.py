"""Rating aggregates, the category list and the stage of a category.

U1 all_products, U2 all_ratings, A1 mean_ratings, A2 new_product_means, A5/C2
category_stage, A7 distinct_raters, A8 rated_new_products, C1/T1 category_top,
T2 category_top_mid, R12 product_mean_rating.

Every aggregate keys on (category, ...): Spark plans a partial HashAggregate before the
shuffle (the map-side combine of the original's aggregateByKey) and a final one after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.config import Config
from pickwise.functions.topk import top_k

PRODUCT_KEY = ["category", "product_id"]


def all_products(products: DataFrame, new_products: DataFrame) -> DataFrame:
    """Established and new products as one bag, with ``is_new``."""
    cols = ["category", "product_id", "product_name", "manufacturer"]
    return products.select(*cols, F.lit(False).alias("is_new")).unionByName(
        new_products.select(*cols, F.lit(True).alias("is_new"))
    )


def all_ratings(ratings: DataFrame, new_product_ratings: DataFrame) -> DataFrame:
    """Established and new-product ratings as one bag."""
    cols = ["category", "user_id", "product_id", "rating"]
    return ratings.select(*cols).unionByName(new_product_ratings.select(*cols))


def mean_ratings(ratings: DataFrame) -> DataFrame:
    """A1 / A2: mean and count of ratings per product (duplicates all count)."""
    return ratings.groupBy(*PRODUCT_KEY).agg(
        F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n_ratings")
    )


def product_stats(ratings: DataFrame, new_product_ratings: DataFrame) -> DataFrame:
    """One pass over both rating tables: per product, sum and count of all its ratings
    and of those in the new-product table. Every rating aggregate of a recommendation
    batch (stage counts, category list, new-product pools) is derived from this table,
    which has one row per rated product however many ratings there are."""
    r = ratings.select(*PRODUCT_KEY, "rating", F.lit(False).alias("_new")).unionByName(
        new_product_ratings.select(*PRODUCT_KEY, "rating", F.lit(True).alias("_new"))
    )
    return r.groupBy(*PRODUCT_KEY).agg(
        F.sum("rating").alias("sum_all"),
        F.count(F.lit(1)).alias("n_all"),
        F.sum(F.when(F.col("_new"), F.col("rating"))).alias("sum_new"),
        F.count(F.when(F.col("_new"), F.lit(1))).alias("n_new"),
    )


def merge_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two summaries as one: the state of a product is merged by adding it up."""
    both = a.unionByName(b).groupBy(*PRODUCT_KEY)
    return both.agg(*[F.sum(c).alias(c) for c in ("sum_all", "n_all", "sum_new", "n_new")])


def means_from_stats(stats: DataFrame) -> DataFrame:
    """A1 from the summary: mean over both tables."""
    return stats.select(
        *PRODUCT_KEY, (F.col("sum_all") / F.col("n_all")).alias("mean_rating"),
        F.col("n_all").alias("n_ratings"),
    )


def new_means_from_stats(stats: DataFrame) -> DataFrame:
    """A2 from the summary: mean over the new-product table, rated products only."""
    return stats.where(F.col("n_new") > 0).select(
        *PRODUCT_KEY, (F.col("sum_new") / F.col("n_new")).alias("mean_rating"),
        F.col("n_new").alias("n_ratings"),
    )


def with_names(df: DataFrame, products: DataFrame) -> DataFrame:
    """Attach product_name by (category, product_id)."""
    names = products.select(*PRODUCT_KEY, "product_name")
    return df.join(names, on=PRODUCT_KEY, how="inner")


def category_top(means: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """The k best products of every category by mean rating (ties: lower id).

    ``products`` should be all products (U1). Names are joined before the cut, so a rated
    product that is in no product table takes no place in the list.
    """
    return top_k(
        with_names(means, products), ["category"], [F.col("mean_rating").desc(), F.col("product_id")], k
    ).select("category", "rank", "product_id", "product_name", "mean_rating")


def category_list(tables, cfg: Config, stats: DataFrame | None = None) -> DataFrame:
    """The stored category list: top ``n_recs`` by mean over both rating tables."""
    p = all_products(tables.products, tables.new_products)
    stats = tables.stats if stats is None else stats
    if stats is not None:
        return category_top(means_from_stats(stats), p, cfg.n_recs)
    r = all_ratings(tables.ratings, tables.new_product_ratings)
    return category_top(mean_ratings(r), p, cfg.n_recs)


def recut(category_recs: DataFrame, k: int) -> DataFrame:
    """Re-cut a stored list to its first k entries (by stored rank)."""
    return category_recs.where(F.col("rank") <= k)


def categories(*dfs: DataFrame) -> DataFrame:
    """The category dimension: every category named by any of the given tables."""
    out = None
    for df in dfs:
        c = df.select("category")
        out = c if out is None else out.unionByName(c)
    return out.distinct()


def category_stage(category_dim: DataFrame, ratings: DataFrame | None, cfg: Config,
                   stats: DataFrame | None = None) -> DataFrame:
    """Rating count per category (0 when it has none) and its stage.

    stage 1: n < stage1; stage 2: stage1 <= n < stage2; stage 3: otherwise.
    Counts come from the rating rows, or from ``product_stats`` when given.
    """
    if stats is not None:
        counts = stats.groupBy("category").agg(F.sum("n_all").alias("n_ratings"))
    else:
        counts = ratings.groupBy("category").agg(F.count(F.lit(1)).alias("n_ratings"))
    n = F.coalesce(F.col("n_ratings"), F.lit(0)).cast("long")
    return (
        category_dim.join(counts, on="category", how="left")
        .select(
            "category",
            n.alias("n_ratings"),
            F.when(n < cfg.stage1, 1).when(n < cfg.stage2, 2).otherwise(3).cast("long")
            .alias("stage"),
        )
    )


def distinct_raters(ratings: DataFrame) -> DataFrame:
    """Every (category, user) with at least one rating."""
    return ratings.select("category", "user_id").distinct()


def rated_new_products(new_product_ratings: DataFrame) -> DataFrame:
    """Every new product with at least one rating."""
    return new_product_ratings.select(*PRODUCT_KEY).distinct()


def product_mean_rating(requested: DataFrame, means: DataFrame) -> DataFrame:
    """Mean rating of the requested (category, product_id) rows, 0.0 if unrated."""
    m = means.select(*PRODUCT_KEY, "mean_rating")
    return requested.join(m, on=PRODUCT_KEY, how="left").withColumn(
        "mean_rating", F.coalesce(F.col("mean_rating"), F.lit(0.0))
    )
