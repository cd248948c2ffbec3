import random

from conftest import rows

from pickwise.functions.sequence import dense_positions
from pickwise.operators import registry as RG


def test_ids_start_at_one_on_empty_table(df):
    users = df([], "USERS")
    req = df([("A", "b@x"), ("A", "a@x"), ("A", "a@x"), ("B", "c@x")], "USER_REQUESTS")
    got = rows(RG.assign_user_ids(req, users), "category", "mail_id", "user_id")
    assert got == [("A", "a@x", 1), ("A", "b@x", 2), ("B", "c@x", 1)]


def test_ids_continue_after_max_and_skip_known(df):
    users = df([("A", 7, "k@x"), ("A", 3, "j@x")], "USERS")
    req = df([("A", "k@x"), ("A", "z@x"), ("A", "m@x")], "USER_REQUESTS")
    assert rows(RG.assign_user_ids(req, users), "mail_id", "user_id") == [("m@x", 8), ("z@x", 9)]
    assert rows(RG.lookup_user_id(req, users), "mail_id", "user_id") == [("k@x", 7)]
    assert rows(RG.user_exists(req, users), "mail_id", "user_exists") == [
        ("k@x", True), ("m@x", False), ("z@x", False)]


def test_name_in_both_product_tables(df):
    prods = df([("A", 5, "dup", "m1")], "PRODUCTS")
    new = df([("A", 2, "dup", "m2"), ("A", 9, "fresh", "m3")], "PRODUCTS")
    req = df([("A", "dup", "x"), ("A", "fresh", "x"), ("A", "none", "x")], "PRODUCT_REQUESTS")
    got = rows(RG.lookup_product_id(req, prods, new), "product_name", "product_id", "is_new")
    assert got == [("dup", 5, False), ("fresh", 9, True)]
    assert rows(RG.product_is_new(req, new), "product_name", "is_new") == [
        ("dup", True), ("fresh", True), ("none", False)]
    onboard = rows(RG.onboard_products(req, prods, new), "product_name", "product_id")
    assert onboard == [("none", 10)]


def test_dense_positions_match_row_number_under_skew(spark):
    rnd = random.Random(5)
    data = [("hot", f"k{rnd.randrange(10**9):09d}") for _ in range(3000)]
    data += [(f"c{i % 7}", f"k{rnd.randrange(10**9):09d}") for i in range(1500)]
    data = list(set(data))
    d = spark.createDataFrame(data, "g string, k string")
    got = rows(dense_positions(d, ["g"], ["k"], "pos", partitions=16), "g", "k", "pos")
    want = []
    for g in sorted({g for g, _ in data}):
        for i, k in enumerate(sorted(k for gg, k in data if gg == g)):
            want.append((g, k, i))
    assert got == sorted(want)


def test_dense_positions_global(spark):
    d = spark.createDataFrame([(i,) for i in range(500, 0, -1)], "k long")
    got = rows(dense_positions(d, [], ["k"], "pos", partitions=7), "k", "pos")
    assert got == [(k, k - 1) for k in range(1, 501)]
