from conftest import rows

from pickwise.config import DEFAULT as CFG
from pickwise.operators import newproducts as NP
from pickwise.sources.tables import Tables


def _tables(df, new_ids, new_ratings, shown=()):
    new = df([("A", i, f"n{i}", "m") for i in new_ids], "PRODUCTS")
    return Tables(
        users=df([("A", u, f"u{u}") for u in range(1, 21)], "USERS"),
        products=df([("A", 1, "p1", "m")], "PRODUCTS"),
        new_products=new,
        ratings=df([("A", 1, 1, 4.0)], "RATINGS"),
        new_product_ratings=df(list(new_ratings), "RATINGS"),
        shown=df([("A", n) for n in shown], "SHOWN"),
    )


def test_promotion_is_strictly_more_than_two(df):
    r = [("A", u, 10, 3.0) for u in (1, 2)] + [("A", u, 20, 3.0) for u in (1, 2, 3)]
    t = _tables(df, [10, 20, 30], r)
    assert rows(NP.promotion_list(t.new_product_ratings, CFG), "product_id", "n_ratings") == [(20, 3)]


def test_promote_conserves_rows_and_is_idempotent(df):
    r = [("A", u, 10, 3.0) for u in (1, 2)] + [("A", u, 20, 3.0) for u in (1, 2, 3, 4)]
    t = _tables(df, [10, 20, 30], r)
    out = NP.promote(t, CFG)
    assert out["products"].count() + out["new_products"].count() == 1 + 3
    assert out["ratings"].count() + out["new_product_ratings"].count() == 1 + 6
    assert rows(out["new_products"], "product_id") == [(10,), (30,)]
    t2 = t.with_(**{k: v for k, v in out.items()})
    again = NP.promote(t2, CFG)
    assert again["products"].count() == out["products"].count()
    assert again["new_product_ratings"].count() == out["new_product_ratings"].count()


def test_pools_and_empty_rated_pool(df):
    t = _tables(df, [10, 20, 30, 40, 50, 60], [], shown=["n20", "n20", "n10"])
    pool = NP.least_shown_unrated(t.new_products, t.new_product_ratings, t.shown, 4)
    assert rows(pool, "rank", "product_id", "n_shown") == [(1, 30, 0), (2, 40, 0), (3, 50, 0), (4, 60, 0)]
    recs = NP.new_product_recs(t.users, t, CFG)
    # the rated pool is empty: one pick per user, from the unrated pool only
    assert recs.count() == 20
    assert {r["source"] for r in recs.collect()} == {"new_unrated"}
    assert {r["product_id"] for r in recs.collect()} <= {30, 40, 50, 60}


def test_empty_unrated_pool(df):
    t = _tables(df, [10], [("A", 1, 10, 5.0)])
    recs = NP.new_product_recs(t.users, t, CFG)
    assert {(r["slot"], r["product_id"], r["source"]) for r in recs.collect()} == {(1, 10, "new_rated")}


def test_sample_fewer_than_five_and_distinct(df):
    t = _tables(df, [10, 20, 30], [])
    s = NP.sample_new(t.users, t.new_products, CFG)
    by_user = {}
    for r in s.collect():
        by_user.setdefault(r["user_id"], []).append((r["slot"], r["product_id"]))
    assert len(by_user) == 20
    for items in by_user.values():
        assert sorted(sl for sl, _ in items) == [0, 1, 2]
        assert sorted(p for _, p in items) == [10, 20, 30]
    t = _tables(df, list(range(10, 200, 10)), [])
    s = NP.sample_new(t.users, t.new_products, CFG)
    for u, grp in s.groupBy("user_id").agg({"product_id": "collect_set"}).collect():
        assert len(grp) == 5
