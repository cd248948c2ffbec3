"""Input tables: what they cost and what they hold."""

from pickwise.plans.fixtures import Fixtures


def test_history_is_grouped_where_its_lines_meet_their_orders(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("customer", [(1, "A"), (2, None)], "c_custkey long, c_mktsegment string")
    put("orders", [(10, 1), (11, 2), (12, None), (10, 1)], "o_orderkey long, o_custkey long")
    put("part", [(5, "bolt"), (6, None)], "p_partkey long, p_name string")
    put("lineitem", [(10, 2, 5, 1.0, "N"), (10, 1, 5, 2.0, "N"), (10, 3, 6, 1.0, "N"), (11, 1, 5, 1.0, "N"), (12, 1, 5, 1.0, "N"), (None, 1, 5, 1.0, "N"), (10, 4, 5, 1.0, "R")],
        "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_returnflag string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Fixtures.history.fget.derive(Fixtures(spark, str(tmp_path)))
        got = sorted(map(tuple, out.collect()), key=str)
        plan = out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    twice = "bolt #5:bolt #5:bolt #5:bolt #5"  # an order that is there twice
    assert got == [("A", 1, 10, twice), (None, 2, 11, "bolt #5")]
    # two sides of each of the three joins, and none for the groups
    assert plan.count("Exchange hashpartitioning") == 6, plan
