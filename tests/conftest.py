import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from haulmark.session import spark_session
    shared = tempfile.mkdtemp(prefix="haulmark-tests-")
    session = spark_session("tests", "local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def rows(spark):
    """Small frames from tuples; times are given as text and stored without zone."""
    def make(data, schema):
        from pyspark.sql import functions as F
        parts = [p.split() for p in schema.split(",")]
        plain = ", ".join(f"{n} {'string' if t == 'ts' else t}" for n, t in parts)
        df = spark.createDataFrame([tuple(r) for r in data], plain)
        return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in parts if t == "ts"}) if any(t == "ts" for _, t in parts) else df
    return make


def values(df, *columns):
    """Sorted tuples, times as text."""
    out = []
    for r in df.select(*columns).collect() if columns else df.collect():
        out.append(tuple(str(v) if hasattr(v, "isoformat") else v for v in r))
    return sorted(out, key=repr)
