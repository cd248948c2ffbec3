from conftest import rows

from pickwise.functions.lists import explode_list
from pickwise.operators import feedback as FB


def test_route_reject_reasons_and_targets(df):
    prods = df([("A", 1, "old", "m"), ("A", 5, "both", "m")], "PRODUCTS")
    new = df([("A", 2, "new", "m"), ("A", 3, "both", "m")], "PRODUCTS")
    fb = df([
        ("A", 1, "old", -1.0, 1), ("A", 1, "new", 0.0, 1), ("A", 2, "old", 5.0, 1),
        ("A", 3, "old", 5.1, 1), ("A", 4, "ghost", 3.0, 1), ("A", 5, "both", 4.0, 1),
        ("A", 6, "old", None, 1),
    ], "FEEDBACK")
    got = rows(FB.route_feedback(fb, prods, new), "user_id", "product_id", "target", "reason")
    assert got == [
        (1, 1, "rejected", "out_of_range"), (1, 2, "new_product_ratings", None),
        (2, 1, "ratings", None), (3, 1, "rejected", "out_of_range"),
        (4, None, "rejected", "unknown_product"),
        (5, 5, "new_product_ratings", None),  # target by the new list, id established first
        (6, 1, "rejected", "missing_rating"),
    ]


def test_feedback_batch_keeps_last_by_seq(df):
    fb = df([("A", 1, "x", 2.0, 1), ("A", 1, "x", 4.0, 3), ("A", 1, "x", 1.0, 2),
             ("A", 1, "y", 2.0, 5), ("A", 1, "y", 3.0, 5)], "FEEDBACK")
    assert rows(FB.feedback_batch(fb), "product_name", "rating", "seq") == [("x", 4.0, 3), ("y", 3.0, 5)]


def test_history_round_trip_and_latest_batch(df):
    recs = df([("A", 1, 1, 2, "b", "s"), ("A", 1, 0, 1, "a", "s"), ("A", 1, 2, 3, "c", "s")], "RECS")
    pushed = FB.push_recommendations(recs, 7)
    assert rows(pushed, "user_id", "batch_id", "product_list") == [(1, 7, "a:b:c")]
    hist = pushed.unionByName(df([("A", 1, 3, "old:list")], "HISTORY"))
    last = FB.last_recommendations(hist)
    assert rows(last, "batch_id", "slot", "product_name") == [(7, 0, "a"), (7, 1, "b"), (7, 2, "c")]
    assert rows(explode_list(df([("A", 1, 1, "solo")], "HISTORY"), "product_list"),
                "slot", "product_name") == [(0, "solo")]
