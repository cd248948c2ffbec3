from conftest import rows

from pickwise.config import DEFAULT as CFG
from pickwise.operators import recommend as RC
from pickwise.operators.ratings import category_list
from pickwise.sources.tables import Tables


def _snapshot(df, ratings=(), new_ratings=(), user_recs=(), n_new=6):
    return Tables(
        users=df([(c, u, f"{c}{u}") for c in "AB" for u in range(1, 6)], "USERS"),
        products=df([(c, p, f"{c}p{p}", "m") for c in "AB" for p in range(1, 9)], "PRODUCTS"),
        new_products=df([(c, p, f"{c}n{p}", "m") for c in "AB" for p in range(10, 10 + n_new)], "PRODUCTS"),
        ratings=df(list(ratings), "RATINGS"),
        new_product_ratings=df(list(new_ratings), "RATINGS"),
        shown=df([], "SHOWN"),
        user_recs=df(list(user_recs), "USER_RECS"),
    )


def _users(t):
    return t.users.select("category", "user_id")


def test_all_empty_ratings_is_stage_one_with_samples(df):
    t = _snapshot(df)
    out = RC.recommend(_users(t), t, CFG)
    assert {r["stage"] for r in out.collect()} == {1}
    assert out.count() == 10 * 5


def test_no_new_products_gives_no_sample_rows(df):
    t = _snapshot(df, n_new=0)
    assert RC.recommend(_users(t), t, CFG).count() == 0


def test_user_with_only_new_product_ratings_gets_als_rows(df):
    r = [("A", u, p, 3.0) for u in (2, 3) for p in (1, 2)]
    nr = [("A", 1, 10, 5.0)]  # user 1 rated only a new product
    recs = [("A", 1, 5, 0.9), ("A", 1, 6, 0.8), ("A", 1, 7, 0.7), ("A", 1, 8, 0.6), ("A", 4, 5, 1.0)]
    t = _snapshot(df, r, nr, recs)
    lst = category_list(t, CFG)
    out = RC.final_recs(_users(t).where("category = 'A'"), t, lst, CFG)
    by_user = {}
    for row in out.collect():
        by_user.setdefault(row["user_id"], []).append((row["slot"], row["product_id"], row["source"]))
    assert sorted(by_user[1]) == [(0, 5, "als"), (1, 6, "als"), (2, 7, "als")]
    # user 4 has ALS rows but no ratings: falls back to the category list
    assert {s for _, _, s in by_user[4]} == {"category"}
    # users 2, 3 rated but have no ALS rows: category list
    # (only three products of A are rated, so the category list has three entries)
    assert sorted(by_user[2]) == [(0, 10, "category"), (1, 1, "category"), (2, 2, "category")]


def test_mid_stage_dedupes_a_new_product_already_listed(df):
    # B has one rating, on new product 10: stage 2 and 10 tops B's category list, and
    # it is also the only rated new product, so the rated pick repeats it
    t = _snapshot(df, new_ratings=[("B", 1, 10, 5.0)])
    out = RC.recommend(_users(t).where("category = 'B'"), t, CFG)
    for u in range(1, 6):
        lst = sorted((r["slot"], r["product_id"]) for r in out.collect() if r["user_id"] == u)
        ids = [p for _, p in lst]
        assert len(ids) == len(set(ids)) and [s for s, _ in lst] == list(range(len(lst)))
        assert ids[0] == 10


def test_result_invariant_under_repartition(df):
    r = [("A", u, p, float(1 + (u * p) % 5)) for u in range(1, 6) for p in range(1, 9)]
    nr = [("A", u, 10 + u % 3, float(1 + u % 5)) for u in range(1, 6)]
    t = _snapshot(df, r, nr, [("A", u, p, 1.0 / p) for u in range(1, 6) for p in range(1, 5)])
    a = rows(RC.recommend(_users(t), t, CFG))
    t2 = Tables(**{k: (v.repartition(7) if v is not None else None) for k, v in t.__dict__.items()})
    assert rows(RC.recommend(_users(t2).repartition(3), t2, CFG)) == a
