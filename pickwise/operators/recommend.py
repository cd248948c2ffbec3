"""Recommendation strategies and the stage dispatch.

Every strategy returns rows (category, user_id, slot, product_id, product_name, source)
with slot 0 first. The dispatch joins request users to their category's stage and runs
each strategy only on the users of that stage, as one plan (a union), instead of one
branch per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.config import Config
from pickwise.functions.broadcast import Broadcaster, bounded, checked
from pickwise.functions.topk import top_k
from pickwise.operators import newproducts as NP
from pickwise.operators.ratings import (
    all_products, all_ratings, categories, category_list, category_stage, product_stats, recut,
    with_names,
)
from pickwise.operators.registry import has_ratings
from pickwise.session import cut_lineage

USER = ["category", "user_id"]
REC_COLS = ["category", "user_id", "slot", "product_id", "product_name", "source"]


def _list_for_users(users: DataFrame, lst: DataFrame, source: str,
                    bc: Broadcaster = checked) -> DataFrame:
    """Give every user the per-category list ``lst`` (rank 1 -> slot 0)."""
    return users.select(*USER).join(bc(lst), on="category", how="inner").select(
        *USER, (F.col("rank") - 1).cast("long").alias("slot"), "product_id", "product_name",
        F.lit(source).alias("source"),
    )


def initial_recs(users: DataFrame, tables, cfg: Config, bc: Broadcaster = checked) -> DataFrame:
    """C4 (stage 1): a hash-order sample of new products."""
    return NP.sample_new(users, tables.new_products, cfg, bc, tables.new_order)


def mid_recs(users: DataFrame, tables, category_recs: DataFrame, cfg: Config,
             stats: DataFrame | None = None, bc: Broadcaster = checked) -> DataFrame:
    """C5 (stage 2): the first ``n_recs - n_new`` of the category list, then the new
    product picks. A product already listed keeps its first slot; the list closes up."""
    est = _list_for_users(users, recut(category_recs, cfg.n_established), "category", bc)
    new = NP.new_product_recs(users, tables, cfg, stats, bc).withColumn(
        "slot", F.col("slot") + cfg.n_established
    )
    both = est.unionByName(new)
    # one group per user (at most n_recs rows): sort by slot, drop a product seen in an
    # earlier slot, renumber -- a single shuffle on the user key
    items = F.array_sort(F.collect_list(F.struct("slot", "product_id", "product_name", "source")))
    ids = F.transform(F.col("_l"), lambda x: x["product_id"])
    firsts = F.filter(F.col("_l"), lambda x, i: ~F.array_contains(F.slice(ids, 1, i), x["product_id"]))
    return (
        both.groupBy(*USER).agg(items.alias("_l"))
        .select(*USER, F.posexplode(firsts).alias("slot", "_x"))
        .select(*USER, F.col("slot").cast("long").alias("slot"), "_x.product_id",
                "_x.product_name", "_x.source")
    )


def final_recs(users: DataFrame, tables, category_recs: DataFrame, cfg: Config,
               bc: Broadcaster = checked) -> DataFrame:
    """C6 (stage 3): the user's ALS rows when the user has ratings and ALS rows;
    otherwise the category list."""
    raters = tables.raters if tables.raters is not None else all_ratings(tables.ratings, tables.new_product_ratings)
    rated = has_ratings(users, raters).where("has_ratings").select(*USER)
    als = top_k(
        tables.user_recs.join(rated, on=USER, how="left_semi"),
        USER, [F.col("score").desc(), F.col("product_id")], cfg.n_established,
    )
    # at most n_recs - n_new rows per requested user, read twice below: written once
    als = cut_lineage(with_names(als, all_products(tables.products, tables.new_products)).select(
        *USER, (F.col("rank") - 1).cast("long").alias("slot"), "product_id", "product_name",
        F.lit("als").alias("source"),
    ))
    fallback = users.select(*USER).join(als.select(*USER).distinct(), on=USER, how="left_anti")
    return als.unionByName(_list_for_users(fallback, category_recs, "category", bc))


def stages(tables, cfg: Config, *extra_category_sources: DataFrame,
           stats: DataFrame | None = None) -> DataFrame:
    """C2 over the snapshot; the category dimension also covers categories with no
    ratings at all (and any request tables given)."""
    dim = categories(tables.users, tables.products, tables.new_products, *extra_category_sources)
    stats = tables.stats if stats is None else stats
    if stats is not None:
        return category_stage(dim, None, cfg, stats)
    return category_stage(dim, all_ratings(tables.ratings, tables.new_product_ratings), cfg)


def snapshot_stats(tables) -> DataFrame:
    """The per-product rating summary of a snapshot, written once to the shared folder
    so that every strategy of the batch reads it. A store's snapshot brings it along; only
    without one is it aggregated from the ratings."""
    if tables.stats is not None:
        return cut_lineage(tables.stats)
    return cut_lineage(product_stats(tables.ratings, tables.new_product_ratings))


def recommend(
    users: DataFrame,
    tables,
    cfg: Config,
    stage: DataFrame | None = None,
    category_recs: DataFrame | None = None,
) -> DataFrame:
    """Dispatch every requested (category, user_id) by the stage of its category."""
    stats = snapshot_stats(tables)
    if stage is None:
        stage = stages(tables, cfg, users, stats=stats)
    # one row per category: its count bounds every per-category list and pool
    stage = cut_lineage(stage.select("category", "stage"))
    per_cat = max(cfg.n_recs, cfg.unrated_pool, cfg.rated_pool, 1)
    bc = bounded(stage.count(), per_cat, cfg.broadcast_rows)
    if category_recs is None:
        # from the snapshot, never a stored list: that one may be missing, stale or of any
        # length; at most n_recs rows per category, read by two strategies: written once
        category_recs = cut_lineage(category_list(tables, cfg, stats))
    staged = users.select(*USER).join(bc(stage), on="category")
    by = lambda s: staged.where(F.col("stage") == s).select(*USER)
    # a stage that no category is in needs no plan
    present = {r["stage"] for r in stage.select("stage").distinct().collect()}  # at most three values
    strategies = {
        1: lambda u: initial_recs(u, tables, cfg, bc),
        2: lambda u: mid_recs(u, tables, category_recs, cfg, stats, bc),
        3: lambda u: final_recs(u, tables, category_recs, cfg, bc),
    }
    out = None
    for s, recs in strategies.items():
        if s in present:
            part = recs(by(s)).withColumn("stage", F.lit(s).cast("long"))
            out = part if out is None else out.unionByName(part)
    if out is None:  # no category at all
        out = final_recs(by(3), tables, category_recs, cfg, bc).withColumn("stage", F.lit(3).cast("long"))
    return out
