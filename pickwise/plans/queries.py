"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query builds the engine inputs from the driver's tables (``Fixtures``) and runs
the engine's operators on them; nothing here re-implements an operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.config import DEFAULT, Config
from pickwise.operators import factorization as MF
from pickwise.operators import feedback as FB
from pickwise.operators import newproducts as NP
from pickwise.operators import ratings as R
from pickwise.operators import recommend as RC
from pickwise.operators import registry as RG
from pickwise.plans import jobs as J
from pickwise.plans.fixtures import Fixtures
from pickwise.session import cut_lineage, scratch_path
from pickwise.sources import legacy as L
from pickwise.sources import models as M
from pickwise.sources.tables import STORED, TableStore
from pickwise.sources.text import check_products, parse_rating_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


CFG: Config = DEFAULT


# --- unions and aggregates --------------------------------------------------------------
@query("all_products")
def q_all_products(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return R.all_products(fx.products, fx.new_products)


@query("all_ratings")
def q_all_ratings(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return R.all_ratings(fx.ratings, fx.new_product_ratings)


@query("mean_ratings")
def q_mean_ratings(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return R.mean_ratings(R.all_ratings(fx.ratings, fx.new_product_ratings))


@query("category_top")
def q_category_top(spark, sf_dir):
    return R.category_list(_fx(spark, sf_dir).tables(), CFG)


@query("category_top_mid")
def q_category_top_mid(spark, sf_dir):
    return R.recut(R.category_list(_fx(spark, sf_dir).tables(), CFG), CFG.n_established)


@query("new_product_means")
def q_new_product_means(spark, sf_dir):
    return R.mean_ratings(_fx(spark, sf_dir).new_product_ratings)


@query("distinct_raters")
def q_distinct_raters(spark, sf_dir):
    return R.distinct_raters(_fx(spark, sf_dir).ratings)


@query("rated_new_products")
def q_rated_new_products(spark, sf_dir):
    return R.rated_new_products(_fx(spark, sf_dir).new_product_ratings)


@query("category_stage")
def q_category_stage(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RC.stages(fx.tables(), fx.stage_config(CFG))


@query("product_mean_rating")
def q_product_mean_rating(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    ids = R.all_products(fx.products, fx.new_products).select("category", "product_id")
    means = R.mean_ratings(R.all_ratings(fx.ratings, fx.new_product_ratings))
    return R.product_mean_rating(ids, means)


# --- registry ---------------------------------------------------------------------------
@query("user_exists")
def q_user_exists(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.user_exists(fx.user_requests, fx.users)


@query("lookup_user_id")
def q_lookup_user_id(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.lookup_user_id(fx.user_requests, fx.users)


@query("assign_user_ids")
def q_assign_user_ids(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.assign_user_ids(fx.user_requests, fx.users)


@query("register_users")
def q_register_users(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.register_users(fx.user_requests, fx.users)


@query("product_exists")
def q_product_exists(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.product_exists(fx.product_requests, fx.products, fx.new_products)


@query("lookup_product_id")
def q_lookup_product_id(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.lookup_product_id(fx.product_requests, fx.products, fx.new_products)


@query("assign_product_ids")
def q_assign_product_ids(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.assign_product_ids(fx.product_requests, fx.products, fx.new_products)


@query("onboard_products")
def q_onboard_products(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.onboard_products(fx.product_requests, fx.products, fx.new_products)


@query("product_is_new")
def q_product_is_new(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.product_is_new(fx.product_requests, fx.new_products)


@query("product_names")
def q_product_names(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return R.with_names(fx.user_recs, R.all_products(fx.products, fx.new_products))


@query("has_ratings")
def q_has_ratings(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RG.has_ratings(fx.users, R.all_ratings(fx.ratings, fx.new_product_ratings))


# --- new products -----------------------------------------------------------------------
@query("shown_counts")
def q_shown_counts(spark, sf_dir):
    return NP.shown_counts(_fx(spark, sf_dir).shown)


@query("promotion_list")
def q_promotion_list(spark, sf_dir):
    return NP.promotion_list(_fx(spark, sf_dir).new_product_ratings, CFG)


def _plist(fx):
    return NP.promotion_list(fx.new_product_ratings, CFG)


@query("promoted_products")
def q_promoted_products(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.promoted(fx.new_products, _plist(fx))


@query("promoted_ratings")
def q_promoted_ratings(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.promoted(fx.new_product_ratings, _plist(fx))


@query("remaining_new_products")
def q_remaining_new_products(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.remaining(fx.new_products, _plist(fx))


@query("remaining_new_ratings")
def q_remaining_new_ratings(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.remaining(fx.new_product_ratings, _plist(fx))


def long_form(tables: dict) -> "DataFrame":
    """Several tables as one long table with a ``table_name`` column."""
    cols = {"category": "string", "product_id": "long", "product_name": "string",
            "manufacturer": "string", "user_id": "long", "rating": "double"}
    out = None
    for name, df in sorted(tables.items()):
        sel = [F.lit(name).alias("table_name")] + [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in cols.items()
        ]
        part = df.select(*sel)
        out = part if out is None else out.unionByName(part)
    return out


@query("promote_products")
def q_promote_products(spark, sf_dir):
    return long_form(NP.promote(_fx(spark, sf_dir).tables(), CFG))


@query("top_rated_new")
def q_top_rated_new(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.top_rated_new(fx.new_product_ratings, fx.new_products, CFG.rated_pool)


@query("least_shown_unrated")
def q_least_shown_unrated(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.least_shown_unrated(fx.new_products, fx.new_product_ratings, fx.shown, CFG.unrated_pool)


@query("sample_new")
def q_sample_new(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.sample_new(fx.users, fx.new_products, CFG)


@query("sample_new_stored")
def q_sample_new_stored(spark, sf_dir):
    """T5 from the order that the store keeps: half of the new products committed, the others onboarded after them."""
    fx = _fx(spark, sf_dir)
    store = _store(spark, "sample_new_stored")
    late = F.pmod(F.col("product_id"), F.lit(2)) == 1
    store.append("new_products", fx.new_products.where(~late))
    store.append("new_products", fx.new_products.where(late))
    t = store.load()
    return NP.sample_new(fx.users, t.new_products, CFG, order=t.new_order)


@query("new_product_recs")
def q_new_product_recs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return NP.new_product_recs(fx.users, fx.tables(), CFG)


# --- strategies and dispatch ------------------------------------------------------------
@query("initial_recs")
def q_initial_recs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RC.initial_recs(fx.users, fx.tables(), CFG)


@query("mid_recs")
def q_mid_recs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    t = fx.tables()
    return RC.mid_recs(fx.users, t, R.category_list(t, CFG), CFG)


@query("final_recs")
def q_final_recs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    t = fx.tables()
    return RC.final_recs(fx.users, t, R.category_list(t, CFG), CFG)


@query("recommend")
def q_recommend(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return RC.recommend(fx.users, fx.tables(), fx.stage_config(CFG))


# --- feedback ---------------------------------------------------------------------------
@query("feedback_batch")
def q_feedback_batch(spark, sf_dir):
    return FB.feedback_batch(_fx(spark, sf_dir).feedback)


@query("route_feedback")
def q_route_feedback(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return FB.route_feedback(FB.feedback_batch(fx.feedback), fx.products, fx.new_products)


@query("last_recommendations")
def q_last_recommendations(spark, sf_dir):
    return FB.last_recommendations(_fx(spark, sf_dir).history)


@query("push_recommendations")
def q_push_recommendations(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    t = fx.tables()
    return FB.push_recommendations(RC.final_recs(fx.users, t, R.category_list(t, CFG), CFG), 0)


# --- sources and sinks ------------------------------------------------------------------
def _store(spark, purpose: str) -> TableStore:
    return TableStore(spark, scratch_path(spark, purpose))


@query("scan_category")
def q_scan_category(spark, sf_dir):
    """Write products partitioned by category, read one category back (pruned)."""
    store = _store(spark, "scan_category")
    store.append("products", _fx(spark, sf_dir).products)
    return store.scan_category("products", "BUILDING")


@query("parse_ratings")
def q_parse_ratings(spark, sf_dir):
    """Typed rating rows or a reject reason for every text line."""
    fx = _fx(spark, sf_dir)
    return check_products(parse_rating_lines(fx.raw_rating_lines),
                          R.all_products(fx.products, fx.new_products))


@query("legacy_import")
def q_legacy_import(spark, sf_dir):
    """S1 + S2 on the original text layout: rating lines, products and new products
    written as headerless text/CSV per category folder, imported into a store; the
    imported ratings (bad lines rejected) are read back."""
    fx = _fx(spark, sf_dir)
    base = scratch_path(spark, "legacy_layout")
    L.export_text(fx.raw_rating_lines, base, "ratings")
    L.export_csv(fx.products, base, "products")
    L.export_csv(fx.new_products, base, "new_products")
    store = _store(spark, "legacy_import")
    L.import_legacy(store, base, CFG)
    return store.read("ratings")


@query("sink_append")
def q_sink_append(spark, sf_dir):
    """S3: two appends of the users table, read back."""
    store = _store(spark, "sink_append")
    users = _fx(spark, sf_dir).users
    store.append("users", users)
    store.append("users", users)
    return store.read("users")


@query("sink_overwrite")
def q_sink_overwrite(spark, sf_dir):
    """A category list from established ratings, then the list over all ratings overwrites
    the categories that have reached stage 3, read back."""
    fx = _fx(spark, sf_dir)
    store = _store(spark, "sink_overwrite")
    prods = R.all_products(fx.products, fx.new_products)
    store.append("category_recommendation_data",
                 R.category_top(R.mean_ratings(fx.ratings), prods, CFG.n_recs))
    late = RC.stages(fx.tables(), fx.stage_config(CFG)).where("stage = 3")
    store.overwrite_categories("category_recommendation_data",
                               R.category_list(fx.tables(), CFG).join(late, "category", "left_semi"))
    return store.read("category_recommendation_data")


def _seed_store(spark, sf_dir, purpose: str) -> TableStore:
    store = _store(spark, purpose)
    t = _fx(spark, sf_dir).tables()
    store.commit({name: getattr(t, attr) for attr, name in STORED.items() if getattr(t, attr) is not None})
    return store


@query("promote_job")
def q_promote_job(spark, sf_dir):
    """C8 + S6: promotion published as a new snapshot of four tables, read back."""
    store = _seed_store(spark, sf_dir, "promote_job")
    J.run_promote(store, CFG)
    return long_form({n: store.read(n) for n in
                      ("products", "ratings", "new_products", "new_product_ratings")})


@query("onboard_job")
def q_onboard_job(spark, sf_dir):
    """Onboarding appends unseen product names to new_products, read back."""
    store = _seed_store(spark, sf_dir, "onboard_job")
    J.run_onboard(store, _fx(spark, sf_dir).product_requests)
    return store.read("new_products")


@query("categorical_job")
def q_categorical_job(spark, sf_dir):
    """The category list published to the store, read back."""
    return J.run_categorical(_seed_store(spark, sf_dir, "categorical_job"), CFG)


@query("recommend_job")
def q_recommend_job(spark, sf_dir):
    """E3 over the request table, by the job itself on a store: the lists it returns."""
    fx = _fx(spark, sf_dir)
    store = _seed_store(spark, sf_dir, "recommend_job")
    return J.run_recommend(store, fx.user_requests, fx.feedback, fx.stage_config(CFG), 1)


@query("recommend_job_tables")
def q_recommend_job_tables(spark, sf_dir):
    """Every table that the job appends to, after the same batch came twice."""
    fx = _fx(spark, sf_dir)
    store = _seed_store(spark, sf_dir, "recommend_job_tables")
    for _ in range(2):
        J.run_recommend(store, fx.user_requests, fx.feedback, fx.stage_config(CFG), 1)
    cols = {"category": "string", "user_id": "long", "mail_id": "string", "product_id": "long", "product_name": "string",
            "rating": "double", "reason": "string", "batch_id": "long", "product_list": "string"}
    out = None
    for t in ("users", "ratings", "new_product_ratings", "feedback_rejects", "previous_user_recommendations", "new_product_shown_list"):
        df = store.read(t)
        part = df.select(F.lit(t).alias("table_name"), *((F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in cols.items()))
        out = part if out is None else out.unionByName(part)
    return out


@query("last_recommendations_stored")
def q_last_recommendations_stored(spark, sf_dir):
    """The latest lists that a store keeps up while the history is appended in three parts."""
    store, history = _store(spark, "last_recommendations_stored"), _fx(spark, sf_dir).history
    for k in range(3):
        store.append("previous_user_recommendations", history.where(F.pmod(F.xxhash64("user_id", "batch_id"), F.lit(3)) == k))
    return J.last_lists(store)


# --- factorisation ----------------------------------------------------------------------
@query("train_validate_split")
def q_train_validate_split(spark, sf_dir):
    return MF.split_train_validate(_fx(spark, sf_dir).ratings, CFG)


@query("rmse")
def q_rmse(spark, sf_dir):
    return MF.rmse(_fx(spark, sf_dir).mean_predictions)


# the grid of the jobs, four points at a time
GRID: Config = CFG.with_(grid_parallelism=4)


def _fitted(spark, sf_dir):
    """The first grid point fitted on the training rows, with the index and the validation rows."""
    ix = MF.index_ratings(_fx(spark, sf_dir).ratings, CFG)
    model = MF.fit(ix.data.where("split = 'train'"), CFG.ranks[0], CFG.reg_params[0], CFG)
    return ix, model, ix.data.where("split = 'validate'")


def _trained(spark, sf_dir):
    ix, m, _ = _fitted(spark, sf_dir)
    u = m.userFactors.withColumnRenamed("id", "u").join(ix.users, on="u").select(
        F.lit("user").alias("kind"), "category", F.col("user_id").alias("id"), "features")
    i = m.itemFactors.withColumnRenamed("id", "i").join(ix.items, on="i").select(
        F.lit("item").alias("kind"), "category", F.col("product_id").alias("id"), "features")
    return u.unionByName(i)


@query("als_train")
def q_als_train(spark, sf_dir):
    """M1: the factors of every user and product of the training rows."""
    return _trained(spark, sf_dir)


@query("als_train_digest")
def q_als_train_digest(spark, sf_dir):
    """M1: every user and product of the training rows has one factor of the given rank."""
    return _trained(spark, sf_dir).select("kind", "category", "id", F.size("features").cast("long").alias("rank"))


@query("als_predict")
def q_als_predict(spark, sf_dir):
    """Predictions of the validation rows whose user and product have factors."""
    _, m, valid = _fitted(spark, sf_dir)
    return MF.predict(m, valid).select(*MF.USER, "product_id", "rating", "prediction")


@query("als_predict_digest")
def q_als_predict_digest(spark, sf_dir):
    """Which validation rows get a number."""
    return q_als_predict(spark, sf_dir).withColumn("scored", ~F.isnan("prediction")).drop("prediction")


@query("als_grid")
def q_als_grid(spark, sf_dir):
    """The error of every grid point in every category, and the winners."""
    return MF.grid_search(_fx(spark, sf_dir).ratings, GRID).grid


@query("als_groups_digest")
def q_als_groups_digest(spark, sf_dir):
    """M1, M3: one fit per category at the first grid point; every user and product of the training rows has a factor."""
    alone = CFG.with_(ranks=CFG.ranks[:1], reg_params=CFG.reg_params[:1], fit_ratings=1)
    users, items = MF.winning_factors(MF.grid_search(_fx(spark, sf_dir).ratings, alone))
    u = users.select(F.lit("user").alias("kind"), "category", F.col("user_id").alias("id"), "features")
    i = items.select(F.lit("item").alias("kind"), "category", F.col("product_id").alias("id"), "features")
    return u.unionByName(i).select("kind", "category", "id", F.size("features").cast("long").alias("rank"))


@query("als_grid_digest")
def q_als_grid_digest(spark, sf_dir):
    """M3: every grid point scores every predictable validation row; one winner a category, and it
    has the smallest error."""
    grid = q_als_grid(spark, sf_dir)
    best = grid.groupBy("category").agg(F.min("rmse").alias("_low"), F.sum(F.col("is_best").cast("long")).alias("n_winners"))
    of_winner = grid.where("is_best").select("category", F.col("rmse").alias("_won"))
    return grid.join(best, "category").join(of_winner, "category").select(
        "category", F.col("grid_index").cast("long").alias("grid_index"), F.col("rank").cast("long").alias("rank"), "reg_param",
        "n_scored", "n_winners", (F.col("_won") == F.col("_low")).alias("winner_is_lowest"))


def _whole_factors(spark, sf_dir):
    """Factors of small whole numbers made from the ids of raters and rated products, through the model store."""
    ratings = _fx(spark, sf_dir).ratings
    whole = lambda c, ms: F.array(*[(F.col(c) * m % n - o).cast("float") for m, n, o in ms])
    u = ratings.select(*MF.USER).distinct().withColumn("features", whole("user_id", [(1, 7, 3), (3, 5, 2), (1, 11, 5)]))
    i = ratings.select(*MF.ITEM).distinct().withColumn("features", whole("product_id", [(1, 13, 6), (5, 7, 3), (1, 3, 1)]))
    path = scratch_path(spark, "exact_model")
    M.save_factors(path, u, i, spark.createDataFrame([], M.GRID))
    return M.load_factors(spark, path)[:2]


@query("als_recommend")
def q_als_recommend(spark, sf_dir):
    """M5, U4: top 3 products of the user's category for every rater, by the first grid point's factors."""
    f = cut_lineage(_trained(spark, sf_dir))  # scoring reads the factors several times
    u = f.where("kind = 'user'").select("category", F.col("id").alias("user_id"), "features")
    i = f.where("kind = 'item'").select("category", F.col("id").alias("product_id"), "features")
    return MF.recommend_top_k(u, i, CFG.n_established, CFG)


@query("als_recommend_exact")
def q_als_recommend_exact(spark, sf_dir):
    """M5, S7, U4 on whole-number factors, whose scores are exact and often equal."""
    u, i = _whole_factors(spark, sf_dir)
    return MF.recommend_top_k(u, i, CFG.n_established, CFG)


@query("als_recommend_blocks")
def q_als_recommend_blocks(spark, sf_dir):
    """M5 as it runs when the products are too many to broadcast: block pairs within the bounds."""
    u, i = _whole_factors(spark, sf_dir)
    return MF.recommend_top_k(u, i, CFG.n_established, CFG.with_(score_broadcast_bytes=0, score_block_rows=512))


@query("als_scoring_work")
def q_als_scoring_work(spark, sf_dir):
    """M5: the share of all pairs of raters and products that were scored."""
    f = cut_lineage(_trained(spark, sf_dir))  # scoring reads the factors several times
    u = f.where("kind = 'user'").select("category", F.col("id").alias("user_id"), "features")
    i = f.where("kind = 'item'").select("category", F.col("id").alias("product_id"), "features")
    return MF.scoring_work(MF.recommend_top_k(u, i, CFG.n_established, CFG, work=True), i)


@query("als_save_load")
def q_als_save_load(spark, sf_dir):
    """An ALS model saved and loaded back scores the validation rows as before."""
    _, m, valid = _fitted(spark, sf_dir)
    path = scratch_path(spark, "als_model")
    M.save_als(m, path)
    again = MF.predict(M.load_als(path), MF.predict(m, valid).withColumnRenamed("prediction", "before"))
    return again.select(*MF.USER, "product_id", "rating", (F.col("prediction") == F.col("before")).alias("same"))


@query("mf_job")
def q_mf_job(spark, sf_dir):
    """The full grid, model save/load, user_recommendation_data replaced, read back."""
    return J.run_mf(_seed_store(spark, sf_dir, "mf_job"), GRID)


@query("mf_job_digest")
def q_mf_job_digest(spark, sf_dir):
    """Lists per user that the job stored."""
    return q_mf_job(spark, sf_dir).groupBy(*MF.USER).agg(F.count("*").alias("n_products"), F.countDistinct("product_id").alias("n_distinct"))


FLAGSHIP = "recommend"
