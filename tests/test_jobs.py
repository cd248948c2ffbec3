"""The batch jobs end to end on a small hand-made store."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pickwise.config import Config
from pickwise.operators import feedback as FB
from pickwise.operators.newproducts import hash_order
from pickwise.operators.ratings import all_ratings, product_stats
from pickwise.operators.recommend import initial_recs
from pickwise.plans import jobs as J
from pickwise.sources.tables import TableStore

CFG = Config(ranks=(3,), reg_params=(0.1,), max_iter=5, als_blocks=2)


def _seed(spark, df):
    rnd = random.Random(3)
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-jobs-"))
    store.append("users", df([(c, u, f"{c}{u}@x") for c in "AB" for u in range(1, 31)], "USERS"))
    store.append("products", df([(c, p, f"{c}-p{p}", "m") for c in "AB" for p in range(1, 16)], "PRODUCTS"))
    store.append("new_products", df([(c, p, f"{c}-n{p}", "m") for c in "AB" for p in range(16, 22)], "PRODUCTS"))
    # A has many ratings (stage 3); B has exactly one (stage 2)
    store.append("ratings", df([("A", u, rnd.randrange(1, 16), float(rnd.randrange(1, 6)))
                                for u in range(1, 31) for _ in range(6)] + [("B", 1, 1, 4.0)], "RATINGS"))
    store.append("new_product_ratings", df([("A", u, 16, 5.0) for u in (1, 2, 3)] + [("A", 4, 17, 2.0)],
                                           "RATINGS"))
    return store


def test_jobs_end_to_end(spark, df):
    store = _seed(spark, df)
    # One known name, one new one
    added = J.run_onboard(store, df([("A", "A-p1", "m"), ("A", "A-fresh", "mk")], "PRODUCT_REQUESTS"))
    assert [(r["product_name"], r["product_id"]) for r in added.collect()] == [("A-fresh", 22)]
    # E1 then E2: the lists the stage-3 and stage-2 strategies read
    recs = J.run_mf(store, CFG)
    assert recs.count() > 0 and recs.groupBy("category", "user_id").count().where("count > 3").count() == 0
    lst = J.run_categorical(store, CFG)
    assert lst.groupBy("category").count().where("count > 5").count() == 0
    # Two known users (with feedback), one unknown mail id per category
    req = df([("A", "A1@x"), ("A", "A2@x"), ("A", "newA@x"), ("B", "newB@x"), ("B", "B5@x")], "USER_REQUESTS")
    fb = df([("A", 1, "A-n18", 4.0, 1), ("A", 2, "A-p3", 9.0, 1), ("A", 2, "nothing", 3.0, 1)], "FEEDBACK")
    out = J.run_recommend(store, req, fb, CFG, batch_id=1)
    got = {(r["mail_id"], r["stage"]) for r in out.collect()}
    assert {m for m, _ in got} == {"A1@x", "A2@x", "newA@x", "newB@x", "B5@x"}
    assert {s for m, s in got if m.startswith(("A", "newA"))} == {3}
    assert {s for m, s in got if m.startswith(("B", "newB"))} == {2}
    users = store.read("users")
    assert users.where(F.col("mail_id") == "newA@x").first()["user_id"] == 31
    assert store.read("new_product_ratings").where("user_id = 1 and product_id = 18").count() == 1
    assert store.read("ratings").where("rating > 5").count() == 0  # the 9.0 was rejected
    hist = store.read("previous_user_recommendations").collect()
    assert {r["batch_id"] for r in hist} == {1} and len(hist) == 5
    shown = store.read("new_product_shown_list").count()
    assert shown == out.where(F.col("source").startswith("new_")).count() > 0
    # Product 16 has 3 ratings (> 2) and moves with its ratings; nothing is lost
    before = (store.read("products").count() + store.read("new_products").count(),
              store.read("ratings").count() + store.read("new_product_ratings").count())
    J.run_promote(store, CFG)
    after = (store.read("products").count() + store.read("new_products").count(),
             store.read("ratings").count() + store.read("new_product_ratings").count())
    assert before == after
    assert store.read("products").where("category = 'A' and product_id = 16").count() == 1
    assert store.read("new_products").where("category = 'A' and product_id = 16").count() == 0
    # a second batch sees the first batch's writes: newA is known now
    out2 = J.run_recommend(store, df([("A", "newA@x")], "USER_REQUESTS"), df([], "FEEDBACK"), CFG, 2)
    assert {r["user_id"] for r in out2.collect()} == {31}
    assert store.read("users").count() == 62


def test_a_batch_that_comes_back_changes_nothing(spark, df):
    store = _seed(spark, df)
    req = df([("A", "A1@x"), ("A", "fresh@x")], "USER_REQUESTS")
    fb = df([("A", 1, "A-p2", 5.0, 1), ("A", 29, "A-p3", 4.0, 1), ("A", 99, "A-p3", 4.0, 1)], "FEEDBACK")
    tables = ("users", "ratings", "new_product_ratings", "previous_user_recommendations", "new_product_shown_list", "feedback_rejects")
    first = sorted(map(tuple, J.run_recommend(store, req, fb, CFG, 7).collect()), key=str)
    sizes = {t: store.read(t).count() for t in tables}
    again = sorted(map(tuple, J.run_recommend(store, req, fb, CFG, 7).collect()), key=str)
    assert first == again and len(first) > 0
    assert {t: store.read(t).count() for t in tables} == sizes
    # a known user who asks for nothing still rates; an unknown one is rejected with a reason
    assert store.read("ratings").where("user_id = 29 and product_id = 3 and rating = 4.0").count() >= 1
    assert [(r["user_id"], r["reason"]) for r in store.read("feedback_rejects").collect()] == [(99, "unknown_user")]


def test_lists_come_from_the_snapshot_not_from_a_stored_list(spark, df):
    """A stage-3 user without ALS rows gets the category list though no categorical run was made."""
    store = _seed(spark, df)
    out = J.run_recommend(store, df([("A", "unseen@x")], "USER_REQUESTS"), df([], "FEEDBACK"), CFG, 1).collect()
    assert len(out) == 5 and {r["source"] for r in out} == {"category"}
    assert store.read("previous_user_recommendations").count() == 1


def _stats(df_):
    cols = ["category", "product_id", "sum_all", "n_all", "sum_new", "n_new"]
    return sorted(tuple(r[c] for c in cols) for r in df_.collect())


def _check_summaries(store):
    t = store.load()
    assert _stats(t.stats) == _stats(product_stats(t.ratings, t.new_product_ratings))
    assert sorted(map(tuple, t.raters.collect())) == sorted(map(tuple, all_ratings(t.ratings, t.new_product_ratings).select("category", "user_id").distinct().collect()))


def test_maintained_summaries_equal_recomputation(spark, df):
    """After appends, batches, a batch that came twice, a promotion and a category overwrite."""
    store = _seed(spark, df)
    _check_summaries(store)
    req = df([("A", "A1@x"), ("B", "newB@x")], "USER_REQUESTS")
    fb = df([("A", 1, "A-p2", 5.0, 1), ("A", 2, "A-n18", 4.0, 1), ("B", 3, "B-p1", 2.0, 1), ("B", 3, "B-n17", 9.0, 1)], "FEEDBACK")
    for batch in (1, 1, 2):
        J.run_recommend(store, req, fb, CFG, batch)
        _check_summaries(store)
    J.run_promote(store, CFG)
    _check_summaries(store)
    store.overwrite_categories("ratings", df([("A", 1, 1, 3.0), ("A", 1, 1, 4.0)], "RATINGS"))
    _check_summaries(store)
    assert store.load().stats.where("category = 'A' and product_id = 1").first()["n_all"] == 2


def test_a_batch_scans_no_ratings(spark, df):
    """Stages, lists, pools and the rated-before test come from the summaries: rating rows that fail when read are not."""
    store = _seed(spark, df)
    fails = lambda d: d.where(F.raise_error(F.concat(F.lit("ratings were read "), F.col("category"))).isNull())
    t = store.load()
    req = df([("A", "A1@x"), ("A", "newA@x"), ("B", "newB@x")], "USER_REQUESTS")
    fb = df([("A", 1, "A-p2", 5.0, 1), ("A", 2, "A-n18", 4.0, 1)], "FEEDBACK")
    want = sorted(map(tuple, J.recommend_plan(req, fb, t.with_(stats=None, raters=None), CFG, 1).recs.collect()))
    broken = t.with_(ratings=fails(t.ratings), new_product_ratings=fails(t.new_product_ratings))
    got = J.recommend_plan(req, fb, broken, CFG, 1)
    assert sorted(map(tuple, got.recs.collect())) == want and want
    with pytest.raises(Exception, match="ratings were read"):
        J.recommend_plan(req, fb, broken.with_(stats=None, raters=None), CFG, 1).recs.collect()


def _check_order(store):
    t = store.load()
    assert t.new_order is not None
    order = lambda d: sorted((r["category"], r["position"], r["product_id"], r["product_name"]) for r in d.collect())
    assert order(t.new_order) == order(hash_order(t.new_products, CFG.sample_seed))


def test_stored_order_of_new_products(spark, df):
    """After appends, onboarding and a promotion it is the order of what is there; a batch's sample looks it up and
    reads no new product, and another seed makes its own order."""
    store = _seed(spark, df)
    _check_order(store)
    J.run_onboard(store, df([("A", "A-fresh", "mk"), ("C", "C-first", "mk")], "PRODUCT_REQUESTS"))
    _check_order(store)
    J.run_promote(store, CFG)
    _check_order(store)
    t = store.load()
    assert t.new_order.where("product_name = 'A-n16'").isEmpty()
    users = df([(c, u) for c in "ABC" for u in range(1, 40)], "category string, user_id long")
    sample = lambda tables, cfg: sorted(map(tuple, initial_recs(users, tables, cfg).collect()))
    want = sample(t.with_(new_order=None), CFG)
    broken = t.with_(new_products=t.new_products.where(F.raise_error(F.col("product_name")).isNull()))
    assert sample(broken, CFG) == want and len(want) == 39 * 5 * 2 + 39
    other = CFG.with_(sample_seed=CFG.sample_seed + 1)
    assert sample(t, other) == sample(t.with_(new_order=None), other) != want


def test_order_of_an_older_store_is_derived(spark, df):
    """Without an order of the last segment the snapshot has none, and without new products neither."""
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-jobs-"))
    assert store.load().new_order is None
    store.append("new_products", df([("A", 1, "x", "m")], "PRODUCTS"))
    assert store.load().new_order.count() == 1
    segs = store.segments()
    spark.createDataFrame([(99, "older", "new_products", segs["new_products"][0], False)], "seq long, commit_id string, table string, segment string, replaces boolean").write.mode("append").parquet(f"{store.root}/_commits")
    assert store.load().new_order is not None  # the same segment again
    spark.createDataFrame([(100, "older", "new_product_order", "", True)], "seq long, commit_id string, table string, segment string, replaces boolean").write.mode("append").parquet(f"{store.root}/_commits")
    assert store.load().new_order is None


def test_cli_runs_a_job(spark, df):
    import os
    import subprocess
    import sys

    store = _seed(spark, df)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    done = subprocess.run([sys.executable, "-m", "pickwise.plans.jobs", store.root, "categorical"],
                          cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    lst = TableStore(spark, store.root).read("category_recommendation_data")
    assert lst.count() > 0 and lst.groupBy("category").count().where("count > 5").count() == 0


def _lists(d):
    return sorted((r["category"], r["user_id"], r["batch_id"], r["slot"], r["product_name"]) for r in d.collect())


def test_latest_lists_equal_the_history_and_stay_small(spark, df):
    """After batches (one that came twice), a late older row and a replaced history; about two rows a user at most."""
    store = _seed(spark, df)
    assert store.load().latest is None and J.last_lists(store).isEmpty()
    size = 0
    for batch in (1, 2, 2, 3, 4):
        J.run_recommend(store, df([("A", "A1@x"), ("A", f"A{batch}@x"), ("B", "B5@x")], "USER_REQUESTS"), df([], "FEEDBACK"), CFG, batch)
        t = store.load()
        assert _lists(J.last_lists(store)) == _lists(FB.last_recommendations(t.history))
        users, rows = t.history.select("category", "user_id").distinct().count(), t.latest.count()
        assert rows < 2 * users + 1
        size = max(size, rows / users)
    assert size > 1  # some commits only added to it
    store.append("previous_user_recommendations", df([("A", 1, 0, "x:y"), ("C", 7, 9, "z"), (None, None, 1, "n")], "HISTORY"))
    got = _lists(J.last_lists(store, df([("A", 1), ("C", 7), ("C", 8)], "category string, user_id long")))
    assert {(c, u, b) for c, u, b, _, _ in got} == {("A", 1, 4), ("C", 7, 9)}
    store.publish({"previous_user_recommendations": df([("A", 1, 1, "old")], "HISTORY")})
    assert _lists(J.last_lists(store)) == [("A", 1, 1, 0, "old")]


def test_latest_lists_of_an_older_store(spark, df):
    """A history whose last segment has no latest lists is read itself; the next commit makes them of all of it."""
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-jobs-"))
    log = "seq long, commit_id string, table string, segment string, replaces boolean"
    store.append("previous_user_recommendations", df([("A", u, 1, f"p{u}") for u in range(5)], "HISTORY"))
    spark.createDataFrame([(50, "older", "previous_user_recommendations_latest", "", True)], log).write.mode("append").parquet(f"{store.root}/_commits")
    assert store.load().latest is None and len(_lists(J.last_lists(store))) == 5
    store.append("previous_user_recommendations", df([("A", 1, 2, "q")], "HISTORY"))
    t = store.load()
    assert t.latest.count() == 5 and ("A", 1, 2, 0, "q") in _lists(J.last_lists(store))
