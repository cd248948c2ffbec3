"""Batch jobs over a ``TableStore`` (E1-E4, C8) and the plans they run.

    python -m pickwise.plans.jobs <root> mf [grid_parallelism] [run_id]
    python -m pickwise.plans.jobs <root> categorical|promote
    python -m pickwise.plans.jobs <root> onboard <product_requests.parquet>
    python -m pickwise.plans.jobs <root> import <folder of the original layout>
    python -m pickwise.plans.jobs <root> recommend <user_requests.parquet> <feedback.parquet> <batch_id>

Each ``*_plan`` function is pure (DataFrames in, DataFrames out); the ``run_*`` functions
read a snapshot from the store, run the plan and write its outputs. One writer at a time.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.config import DEFAULT, Config
from pickwise.operators import factorization as MF
from pickwise.operators import feedback as FB
from pickwise.operators import newproducts as NP
from pickwise.operators import registry as RG
from pickwise.operators.ratings import category_list, merge_stats, product_stats
from pickwise.operators.recommend import recommend
from pickwise.sources import models
from pickwise.session import cut_lineage
from pickwise.sources.legacy import import_legacy
from pickwise.sources.tables import TableStore, Tables


# --- E3: recommend a batch of requests ----------------------------------------------------
@dataclass
class BatchResult:
    recs: DataFrame          # category, mail_id, user_id, slot, product_id, product_name, source, stage
    new_users: DataFrame     # rows appended to users
    routed: DataFrame        # feedback with its target table (or reject reason)


def recommend_plan(requests: DataFrame, feedback: DataFrame, tables: Tables, cfg: Config,
                   batch_id: int) -> BatchResult:
    """Feedback of any known user is routed, unknown requesters are registered; then every
    requester gets a list from one snapshot that already holds this batch's feedback and users."""
    rq = requests.select("category", "mail_id").distinct()
    # request-sized tables read by several branches below: written once
    known = cut_lineage(RG.lookup_user_id(rq, tables.users))
    new_users = RG.assign_user_ids(rq, tables.users)
    req_users = known.unionByName(new_users.select("category", "mail_id", "user_id"))

    routed = cut_lineage(FB.route_feedback(
        FB.feedback_batch(feedback), tables.products, tables.new_products, tables.users
    ))
    rated, rated_new = FB.routed_rows(routed, FB.TARGET_ESTABLISHED), FB.routed_rows(routed, FB.TARGET_NEW)
    if tables.stats is not None:  # the snapshot's summaries move on with the batch
        tables = tables.with_(
            stats=merge_stats(tables.stats, product_stats(rated, rated_new)),
            raters=tables.raters.unionByName(rated.unionByName(rated_new).select("category", "user_id")),
        )
    snap = tables.with_(
        users=tables.users.unionByName(new_users.select(*tables.users.columns)),
        ratings=tables.ratings.unionByName(rated),
        new_product_ratings=tables.new_product_ratings.unionByName(rated_new),
    )
    recs = recommend(req_users.select("category", "user_id"), snap, cfg)
    out = recs.join(req_users, on=["category", "user_id"]).select(
        "category", "mail_id", "user_id", "slot", "product_id", "product_name", "source", "stage"
    )
    return BatchResult(out, new_users, routed)


def run_recommend(store: TableStore, requests: DataFrame, feedback: DataFrame, cfg: Config,
                  batch_id: int) -> DataFrame:
    """One batch, committed as a whole under its id. A batch that comes back changes
    nothing and returns the lists stored for it."""
    commit_id = f"recommend-{batch_id}"
    if not store.committed(commit_id):
        res = recommend_plan(requests, feedback, store.load(), cfg, batch_id)
        # six outputs read them: written once
        recs, users = cut_lineage(res.recs), cut_lineage(res.new_users)
        rejected = res.routed.where(F.col("target") == FB.TARGET_REJECTED)
        store.commit({
            "users": users,
            "ratings": FB.routed_rows(res.routed, FB.TARGET_ESTABLISHED),
            "new_product_ratings": FB.routed_rows(res.routed, FB.TARGET_NEW),
            "feedback_rejects": rejected.withColumn("batch_id", F.lit(batch_id).cast("long")),
            "previous_user_recommendations": FB.push_recommendations(recs, batch_id),
            "new_product_shown_list": NP.exposures(recs),
            "batch_recommendations": recs.withColumn("batch_id", F.lit(batch_id).cast("long")),
        }, commit_id=commit_id)
    return store.read("batch_recommendations").where(F.col("batch_id") == batch_id).drop("batch_id")


def last_lists(store: TableStore, users: DataFrame | None = None) -> DataFrame:
    """C11: items of the latest list of every user, or of the requested (category, user_id), from the
    stored latest lists: what is read follows the users, not the batches they were served in."""
    t = store.load()
    rows = t.history if t.latest is None else t.latest
    return FB.last_recommendations(rows if users is None else RG.requested(rows, users, FB.USER))


# --- E4, C8, E2, E1 -----------------------------------------------------------------------
def run_onboard(store: TableStore, product_requests: DataFrame) -> DataFrame:
    t = store.load()
    rows = cut_lineage(RG.onboard_products(product_requests, t.products, t.new_products))
    store.append("new_products", rows)
    return rows


def run_promote(store: TableStore, cfg: Config) -> None:
    """Read-and-replace of four tables, published as one new snapshot."""
    store.publish(NP.promote(store.load(), cfg))


def run_categorical(store: TableStore, cfg: Config) -> DataFrame:
    lst = category_list(store.load(), cfg)
    store.publish({"category_recommendation_data": lst})
    return store.read("category_recommendation_data")


def run_mf(store: TableStore, cfg: Config, model_path: str | None = None, run_id: str | None = None) -> DataFrame:
    """Grid search over all categories at once, save the model, replace
    user_recommendation_data with the top ``n_recs - n_new`` per rater.

    A ``run_id`` keeps every fitted grid point under the store: a job that died and comes back with the same
    id fits only what is missing."""
    ratings = store.read("ratings")
    res = MF.grid_search(ratings, cfg, f"{store.root}/_runs/{run_id}" if run_id else None)
    uf, itf = MF.winning_factors(res)
    models.save_factors(model_path or f"{store.root}/_model", uf, itf, res.grid)
    uf, itf, _ = models.load_factors(store.spark, model_path or f"{store.root}/_model")
    recs = MF.recommend_top_k(uf, itf, cfg.n_established, cfg).select(
        "category", "user_id", "product_id", "score"
    )
    store.publish({"user_recommendation_data": recs})
    return store.read("user_recommendation_data")


def main(argv: list[str]) -> None:
    from pickwise.session import build_session

    root, job = argv[0], argv[1]
    spark: SparkSession = build_session()
    cfg = DEFAULT
    store = TableStore(spark, root)
    if job == "mf":
        run_mf(store, cfg.with_(grid_parallelism=int(argv[2])) if len(argv) > 2 else cfg, run_id=argv[3] if len(argv) > 3 else None)
    elif job == "categorical":
        run_categorical(store, cfg)
    elif job == "promote":
        run_promote(store, cfg)
    elif job == "onboard":
        run_onboard(store, spark.read.parquet(argv[2]))
    elif job == "recommend":
        run_recommend(store, spark.read.parquet(argv[2]), spark.read.parquet(argv[3]), cfg,
                      int(argv[4]))
    elif job == "import":
        import_legacy(store, argv[2], cfg)
    else:
        raise SystemExit(f"unknown job {job!r}")


if __name__ == "__main__":
    main(sys.argv[1:])
