import os
import tempfile

from conftest import rows

from pickwise import schemas
from pickwise.sources.tables import TableStore
from pickwise.sources.text import check_products, parse_rating_lines, read_csv


def test_parse_rating_lines(df):
    lines = df([("A", "1,2,3"), ("A", "1,2"), ("A", "1,x,3"), ("A", "1,2,5.1"), ("A", "1,2,-1"),
                ("A", "1,9,0"), ("A", "1,2,5"), ("A", "1,2,3,4")], "RAW_RATING_LINES")
    prods = df([("A", 2, "p", "m", False)], "category string, product_id long, product_name string, "
               "manufacturer string, is_new boolean")
    got = rows(check_products(parse_rating_lines(lines), prods), "line", "error")
    assert got == [("1,2", "fields"), ("1,2,-1", "out_of_range"), ("1,2,3", None),
                   ("1,2,3,4", "fields"), ("1,2,5", None), ("1,2,5.1", "out_of_range"),
                   ("1,9,0", "unknown_product"), ("1,x,3", "not_a_number")]


def test_quoted_csv_keeps_commas(spark):
    d = tempfile.mkdtemp(prefix="pickwise-csv-")
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write('A,3,"Name, with comma",maker\n')
    got = read_csv(spark, d, schemas.PRODUCTS).collect()
    assert [tuple(r) for r in got] == [("A", 3, "Name, with comma", "maker")]


def test_store_append_overwrite_publish_and_pruning(spark, df):
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-store-"))
    assert store.read("users").count() == 0
    store.append("users", df([("A", 1, "a"), ("B", 1, "b")], "USERS"))
    store.append("users", df([("A", 2, "c")], "USERS"))
    assert rows(store.read("users"), "category", "user_id") == [("A", 1), ("A", 2), ("B", 1)]
    store.overwrite_categories("users", df([("A", 9, "z")], "USERS"))
    assert rows(store.read("users"), "category", "user_id") == [("A", 9), ("B", 1)]
    scan = store.scan_category("users", "B")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(category" in plan
    assert rows(scan, "user_id") == [(1,)]
    store.publish({"users": df([("C", 1, "q")], "USERS"), "products": df([], "PRODUCTS")})
    assert rows(store.read("users"), "category") == [("C",)]


def test_writers_follow_the_bytes_of_a_category(spark):
    """A category with most of the rows is written by as many tasks as its bytes need, a small one by one (unless its
    hash puts it into the large one's range)."""
    import glob

    from pyspark.sql import functions as F

    n, advisory = 400_000, "200k"
    users = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("S"), (F.col("id") % 5000 / 100).cast("int"))).otherwise("H").alias("category"),
        F.col("id").alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("mail_id"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    try:
        root = tempfile.mkdtemp(prefix="pickwise-files-")
        store = TableStore(spark, root)
        store.append("users", users)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {c: len(glob.glob(f"{root}/users/segment=*/category={c}/*.parquet")) for c in ("H", *(f"S{k}" for k in range(50)))}
    assert files["H"] >= 6 and sum(files[f"S{k}"] == 1 for k in range(50)) >= 40
    assert store.read("users").count() == n
    small = tempfile.mkdtemp(prefix="pickwise-files-")
    TableStore(spark, small).append("users", users.where("user_id < 1000"))
    assert all(len(glob.glob(f"{small}/users/segment=*/category={c}/*.parquet")) == 1 for c in ("H", "S0", "S1"))

def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    from pickwise.session import scratch_path, shared_dir

    root = spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == root
    assert scratch_path(spark, "x").startswith(root)


def test_a_publish_that_died_leaves_nothing(spark, df, monkeypatch):
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-crash-"))
    store.append("users", df([("A", 1, "a")], "USERS"))
    real = spark.createDataFrame
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died before the commit")))
        try:
            store.publish({"users": real([("B", 2, "b"), ("C", 3, "c")], schemas.USERS)})
        except RuntimeError:
            pass
    assert rows(store.read("users"), "category") == [("A",)]
    store.publish({"users": df([("B", 9, "z")], "USERS")})
    assert rows(store.read("users"), "category", "user_id") == [("B", 9)]


def test_a_missing_segment_is_an_error_not_an_empty_table(spark, df):
    import pytest
    from pyspark.errors import AnalysisException

    root = tempfile.mkdtemp(prefix="pickwise-missing-")
    store = TableStore(spark, root)
    store.append("users", df([("A", 1, "a")], "USERS"))
    lost = [(2, "x", "users", "lost", False)]
    spark.createDataFrame(lost, "seq long, commit_id string, table string, segment string, replaces boolean").write.mode("append").parquet(f"{root}/_commits")
    with pytest.raises(AnalysisException):
        store.read("users").count()


def test_a_snapshot_is_of_one_commit(spark, df):
    store = TableStore(spark, tempfile.mkdtemp(prefix="pickwise-snap-"))
    store.commit({"users": df([("A", 1, "a")], "USERS"), "products": df([("A", 1, "p", "m")], "PRODUCTS")}, commit_id="one")
    t = store.load()
    store.publish({"users": df([], "USERS"), "products": df([], "PRODUCTS")})
    assert t.users.count() == t.products.count() == 1
    assert not store.commit({"users": df([("A", 2, "b")], "USERS")}, commit_id="one")
    assert store.read("users").count() == 0


def test_models_are_versioned_and_keep_category_names(spark):
    from pickwise.sources import models

    path = tempfile.mkdtemp(prefix="pickwise-model-")
    def save(cats):
        u = spark.createDataFrame([(c, 1, [1.0]) for c in cats], models.USER_FACTORS)
        i = spark.createDataFrame([(c, 1, [2.0]) for c in cats], models.ITEM_FACTORS)
        models.save_factors(path, u, i, spark.createDataFrame([], models.GRID))
    save(["001", "002"])
    assert {r["category"] for r in models.load_factors(spark, path)[0].collect()} == {"001", "002"}
    save(["001"])
    u, i, _ = models.load_factors(spark, path)
    assert [r["category"] for r in u.collect()] == [r["category"] for r in i.collect()] == ["001"]


def test_submitted_settings_survive():
    import subprocess
    import sys

    code = ("from pickwise.session import build_session; s = build_session();"
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), PYSPARK_SUBMIT_ARGS=(
        "--master local[1] --conf spark.sql.shuffle.partitions=4000 --conf spark.sql.session.timeZone=Asia/Tokyo pyspark-shell"))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "GOT 4000 Asia/Tokyo" in out.stdout, out.stderr[-1500:]
