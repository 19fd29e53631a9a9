from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from adapters.tpch import spark_source
from tidemark.session import BROADCAST_BYTES, SKEW_MIN_BYTES, SKEW_MIN_ROWS, local_session
from tidemark.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def forced_skew(spark):
    """Joins without broadcast that treat a key with more than ten rows above its share as hot."""
    conf = {
        BROADCAST_BYTES[0]: "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        SKEW_MIN_BYTES[0]: "0",
        SKEW_MIN_ROWS[0]: "10",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def without_aqe(spark):
    """As many tasks as configured, however little there is to do."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", [(1, "x")])``"""

    def make(schema, rows):
        types = _parse_datatype_string(schema)
        columns = list(zip(*rows)) or [()] * len(types)
        table = pa.table([list(c) for c in columns], schema=to_arrow_schema(types))
        return spark.createDataFrame(table, types)

    return make


@pytest.fixture
def house(spark, tmp_path):
    """``house(tables)``: a warehouse over source tables given by name."""
    return lambda tables, end=None: Warehouse(spark, str(tmp_path / "house"), tables.__getitem__, end)


@pytest.fixture
def sources(spark):
    return spark_source(spark, SF_DIR)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
