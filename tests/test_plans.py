"""Plan-level checks of the skew policy: no per-user join shuffles on category alone."""

import re

from pickwise.config import Config
from pickwise.operators import factorization as MF
from pickwise.operators import recommend as RC
from pickwise.sources.tables import Tables


def _executed(df):
    """The final adaptive plan: collect() runs the frame's own execution, a write does not."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan  # no exchange, nothing to adapt
    return plan.partition("== Initial Plan ==")[0]


def _category_only_smj(plan):
    return re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[category#\d+\], \[category#\d+\]", plan)


def test_dispatch_never_shuffles_users_on_category_alone(df):
    # one category holds most users
    users = df([("H", u, f"h{u}") for u in range(400)] + [("S", u, f"s{u}") for u in range(5)], "USERS")
    t = Tables(
        users=users,
        products=df([(c, p, f"{c}{p}", "m") for c in "HS" for p in range(1, 9)], "PRODUCTS"),
        new_products=df([(c, p, f"{c}n{p}", "m") for c in "HS" for p in range(10, 16)], "PRODUCTS"),
        ratings=df([("H", u, 1 + u % 8, 3.0) for u in range(400)], "RATINGS"),
        new_product_ratings=df([("S", 1, 10, 4.0)], "RATINGS"),
        shown=df([], "SHOWN"),
        user_recs=df([("H", u, 2, 1.0) for u in range(0, 400, 2)], "USER_RECS"),
    )
    plan = _executed(RC.recommend(users.select("category", "user_id"), t, Config()))
    assert not _category_only_smj(plan), _category_only_smj(plan)
    assert "BroadcastHashJoin" in plan


def test_scoring_paths_do_not_join_on_category_alone(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    uf = spark.createDataFrame(
        [("H", u, [float(x) for x in rng.normal(size=3)]) for u in range(300)], "category string, user_id long, features array<float>")
    itf = spark.createDataFrame(
        [("H", p, [float(x) for x in rng.normal(size=3)]) for p in range(50)], "category string, product_id long, features array<float>")
    for cfg in (Config(), Config(score_broadcast_bytes=0, score_block_rows=16)):
        plan = _executed(MF.recommend_top_k(uf, itf, 3, cfg))
        assert not _category_only_smj(plan)


def test_small_batches_do_not_shuffle_the_whole_tables(spark, tmp_path):
    """Lookups cut the big table to the requested keys before anything is exchanged."""
    from pyspark.sql import functions as F

    from pickwise.operators import registry as RG

    spark.range(200_000).select(F.lit("H").alias("category"), F.col("id").alias("user_id"), F.concat(F.lit("m"), "id").alias("mail_id")).write.parquet(f"{tmp_path}/users")
    spark.range(50).select(F.lit("H").alias("category"), F.concat(F.lit("m"), F.col("id") * 7).alias("mail_id")).write.parquet(f"{tmp_path}/requests")
    users, requests = spark.read.parquet(f"{tmp_path}/users"), spark.read.parquet(f"{tmp_path}/requests")
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)  # the scan's whole path, however long
    try:
        plans = [_executed(df) for df in (RG.lookup_user_id(requests, users), RG.user_exists(requests, users))]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for plan in plans:
        assert "LeftSemi, BuildRight" in plan
        below = plan[plan.index("LeftSemi, BuildRight"):]
        big = below[:below.index("/users")]  # from the semi-join down to the scan of the big table
        assert not re.search(r"\n[^\n]*- Exchange hashpartitioning", big.rpartition("BroadcastExchange")[0] or big.split("BroadcastExchange")[0])


def test_numbering_does_not_shuffle_the_numbered_rows_again(spark):
    from pickwise.functions.sequence import dense_positions

    rows = spark.createDataFrame([("H", n) for n in range(400)] + [("S", n) for n in range(5)], "g string, k long")
    numbered = dense_positions(rows, ["g"], ["k"])
    plan = numbered._jdf.queryExecution().executedPlan().toString()  # before any adaptive change
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert all(r["pos"] == r["k"] for r in numbered.collect())
