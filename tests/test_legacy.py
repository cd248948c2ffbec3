import os
import tempfile

from conftest import rows

from pickwise.config import DEFAULT as CFG
from pickwise.sources.legacy import import_legacy
from pickwise.sources.tables import TableStore


def _write(base, dataset, category, text):
    d = os.path.join(base, dataset, category)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-00000.csv"), "w") as f:
        f.write(text)


def test_import_original_layout(spark):
    base = tempfile.mkdtemp(prefix="pickwise-legacy-")
    _write(base, "users", "HR", "1,a@x\n2,b@x\n")
    _write(base, "users", "Sales", "1,c@x\n")
    _write(base, "products", "HR", '1,"Desk, oak",acme\n2,Chair,acme\n')
    _write(base, "new_products", "HR", "3,Lamp,lux\n")
    _write(base, "ratings", "HR", "1,1,4\n2,2,5\n2,9,3\n1,x,2\n1,2\n")
    _write(base, "new_product_ratings", "HR", "1,3,2.5\n2,3,7\n")
    _write(base, "new_product_shown_list", "HR", "Lamp\nLamp\n")
    _write(base, "category_recommendation_data", "HR", "2,5.0\n1,4.0\n77,3.0\n3,2.0\n1,1.0\n2,0.5\n")
    _write(base, "previous_user_recommendations", "HR", "1,Desk:Chair\n")
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-imported-"))
    rejects = import_legacy(store, base, CFG)
    assert rows(store.read("users"), "category", "user_id", "mail_id") == [
        ("HR", 1, "a@x"), ("HR", 2, "b@x"), ("Sales", 1, "c@x")]
    assert rows(store.read("products"), "product_id", "product_name") == [(1, "Desk, oak"), (2, "Chair")]
    assert rows(store.read("ratings"), "user_id", "product_id", "rating") == [(1, 1, 4.0), (2, 2, 5.0)]
    assert rows(rejects["ratings"], "line", "reason") == [
        ("1,2", "fields"), ("1,x,2", "not_a_number"), ("2,9,3", "unknown_product")]
    assert rows(store.read("new_product_ratings"), "user_id", "rating") == [(1, 2.5)]
    assert rows(rejects["new_product_ratings"], "reason") == [("out_of_range",)]
    assert store.read("new_product_shown_list").count() == 2
    # every stored row, known product or not, however many
    assert [(r["rank"], r["product_id"], r["product_name"]) for r in
            store.read("category_recommendation_data").orderBy("rank").collect()] == [
        (1, 2, "Chair"), (2, 1, "Desk, oak"), (3, 77, None), (4, 3, "Lamp"), (5, 1, "Desk, oak"), (6, 2, "Chair")]
    assert store.read("import_rejects").where("dataset = 'ratings'").count() == 3
    assert rows(store.read("previous_user_recommendations"), "product_list") == [("Desk:Chair",)]


def test_bad_rows_of_every_dataset_are_rejected_and_a_second_import_changes_nothing(spark):
    base = tempfile.mkdtemp(prefix="pickwise-legacy-")
    _write(base, "users", "HR", "1,a@x\nxx,c@d\n3\n,none@x\n2,b@x\n")
    _write(base, "products", "HR", "1,Desk,acme\nD,E\n2,Chair,acme,extra\n")
    _write(base, "user_recommendation_data", "HR", "1,1,0.5\n1,one,0.5\n")
    _write(base, "ratings", "HR", "1,1,4\n1,1\n")
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-imported-"))
    for _ in range(2):
        rejects = import_legacy(store, base, CFG)
        assert rows(store.read("users"), "user_id", "mail_id") == [(1, "a@x"), (2, "b@x")]
        assert rows(rejects["users"], "line", "reason") == [(",none@x", "missing_id"), ("3", "unparseable"), ("xx,c@d", "unparseable")]
        assert rows(store.read("products"), "product_id", "product_name") == [(1, "Desk")]
        assert rows(rejects["products"], "line") == [("2,Chair,acme,extra",), ("D,E",)]
        assert store.read("user_recommendation_data").count() == 1 and rejects["user_recommendation_data"].count() == 1
        assert rows(store.read("ratings"), "user_id", "product_id", "rating") == [(1, 1, 4.0)]
        assert store.read("import_rejects").count() == 7
    assert store.load().stats.count() == 1


def test_an_import_that_dies_leaves_nothing(spark, monkeypatch):
    import pytest

    from pickwise.sources import tables as T

    base = tempfile.mkdtemp(prefix="pickwise-legacy-")
    _write(base, "users", "HR", "1,a@x\n")
    _write(base, "products", "HR", "1,Desk,acme\n")
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-imported-"))
    real, calls = T.write_partitioned, []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **k)

    monkeypatch.setattr(T, "write_partitioned", dies)
    with pytest.raises(RuntimeError):
        import_legacy(store, base, CFG)
    assert store.segments() == {}
    monkeypatch.setattr(T, "write_partitioned", real)
    import_legacy(store, base, CFG)
    assert store.read("users").count() == 1 and store.read("products").count() == 1
