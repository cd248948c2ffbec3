from conftest import rows

from pickwise.config import DEFAULT as CFG
from pickwise.operators import ratings as R


def test_mean_counts_every_duplicate(df):
    r = df([("A", 1, 10, 5.0), ("A", 1, 10, 1.0), ("A", 2, 10, 3.0)], "RATINGS")
    assert rows(R.mean_ratings(r)) == [("A", 10, 3.0, 3)]


def test_category_top_ties_go_to_lower_id(df):
    prods = df([("A", i, f"p{i}", "m") for i in range(1, 9)], "PRODUCTS")
    r = df([("A", 1, i, 4.0) for i in (7, 3, 5, 8, 1, 2)] + [("A", 1, 6, 5.0)], "RATINGS")
    top = R.category_top(R.mean_ratings(r), R.all_products(prods, prods.limit(0)), 5)
    assert rows(top, "rank", "product_id") == [(1, 6), (2, 1), (3, 2), (4, 3), (5, 5)]


def test_category_top_empty(df):
    prods = df([], "PRODUCTS")
    r = df([], "RATINGS")
    assert R.category_top(R.mean_ratings(r), prods.withColumn("is_new", prods.product_id.isNull()), 5).count() == 0


def test_stage_counts_0_1_2_and_category_without_ratings(df):
    dim = df([("Z",), ("O",), ("T",), ("M",)], "category string")
    r = df([("O", 1, 1, 1.0), ("T", 1, 1, 1.0), ("T", 2, 1, 1.0)] + [("M", i, 1, 1.0) for i in range(9)],
           "RATINGS")
    got = rows(R.category_stage(dim, r, CFG), "category", "n_ratings", "stage")
    assert got == [("M", 9, 3), ("O", 1, 2), ("T", 2, 3), ("Z", 0, 1)]


def test_recut_and_product_mean_default(df):
    lst = df([("A", k, k, f"p{k}", 5.0 - k) for k in range(1, 6)], "CATEGORY_RECS")
    assert rows(R.recut(lst, 3), "rank") == [(1,), (2,), (3,)]
    means = df([("A", 1, 4.5, 2)], "category string, product_id long, mean_rating double, n_ratings long")
    req = df([("A", 1), ("A", 2)], "category string, product_id long")
    assert rows(R.product_mean_rating(req, means), "product_id", "mean_rating") == [(1, 4.5), (2, 0.0)]


def test_unnamed_product_takes_no_place_in_the_list(df):
    means = df([("A", p, float(10 - p), 1) for p in range(1, 10)], "category string, product_id long, mean_rating double, n_ratings long")
    prods = df([("A", p, f"p{p}", "m") for p in range(1, 10) if p not in (2, 4)], "PRODUCTS")
    got = R.category_top(means, prods, 5).orderBy("rank").collect()
    assert [(r["rank"], r["product_id"]) for r in got] == [(1, 1), (2, 3), (3, 5), (4, 6), (5, 7)]
