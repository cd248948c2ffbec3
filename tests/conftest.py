import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pickwise.session import build_session

    s = build_session("local[4]", partitions=8, app="pickwise-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pickwise-test-"))
    yield s
    s.stop()


@pytest.fixture
def df(spark):
    from pickwise import schemas

    def make(rows, schema):
        if isinstance(schema, str) and hasattr(schemas, schema):
            schema = getattr(schemas, schema)
        return spark.createDataFrame(rows, schema)

    return make


def rows(df, *order):
    """Collected rows as tuples of the given columns, sorted."""
    cols = list(order) or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
