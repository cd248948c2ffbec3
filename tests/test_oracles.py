"""Every SQL-checked query against its DuckDB oracle on the smallest driver tables."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(E.oracle_sql()) & set(E.REGISTRY))


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    # the solver's floats have no SQL: these return them, their *_digest and *_exact forms are compared
    floats = {"als_train", "als_predict", "als_grid", "als_recommend", "als_scoring_work", "mf_job"}
    assert set(E.REGISTRY) - floats <= set(E.oracle_sql())


def test_trained_values_come_back(spark):
    f = E.queries()["als_train"](spark, SF)
    assert f.where("size(features) = 5").count() == f.count() > 0
    p = E.queries()["als_predict"](spark, SF)
    assert p.columns == ["category", "user_id", "product_id", "rating", "prediction"] and p.where("isnan(prediction)").count() == 0
    r = E.queries()["als_recommend"](spark, SF).collect()
    assert r and all(x["rank"] <= 3 and math.isfinite(x["score"]) for x in r)
    for w in E.queries()["als_scoring_work"](spark, SF).collect():
        assert 0 < w["n_scored"] <= w["n_users"] * w["n_items"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"category", "user_id", "slot", "product_id", "product_name"}


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    got = E.queries()[key](spark, SF)
    cols, data = got.columns, [tuple(r) for r in got.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols, odata = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    duck = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    spark_types = {f.name: duck.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in got.schema.fields}
    assert spark_types == {d[0]: str(d[1]) for d in res.description}
    assert len(data) == len(odata)
    assert _digest(cols, data) == _digest(ocols, odata)
