import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    """The smallest tables; tests that need them are skipped elsewhere."""
    d = f"{DATA}/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data here")
    return d


@pytest.fixture(scope="session")
def bare(small, tmp_path_factory):
    """Folders with the tables' schemas: one of empty tables, one of four rows in which everything is null."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    empty, nulls = tmp_path_factory.mktemp("empty"), tmp_path_factory.mktemp("nulls")
    for f in os.listdir(small):
        t = pq.read_table(f"{small}/{f}")
        pq.write_table(t.slice(0, 0), empty / f)
        pq.write_table(pa.table({x.name: pa.nulls(4, x.type) for x in t.schema}), nulls / f)
    return str(empty), str(nulls)
