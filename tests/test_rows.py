from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import quality, rows
from tidemark.operators.keys import assign_ids
from tidemark.operators.quality import Rules, RuleViolation


def test_first_and_last_with_null_order_and_ties(frame):
    df = frame("k string, o int, v string", [("a", 2, "x"), ("a", None, "y"), ("b", 1, "p"), ("b", 1, "q"), ("c", None, "z")])
    assert values(rows.collapse(df, ["k"], ["o"], "first")) == [("a", None, "y"), ("b", 1, "p"), ("c", None, "z")]
    assert values(rows.collapse(df, ["k"], ["o"], "last")) == [("a", 2, "x"), ("b", 1, "q"), ("c", None, "z")]


@pytest.mark.parametrize("exact", [True, False])
def test_same_rows(frame, exact):
    schema = "a int, b string, c double"
    base = [(1, "x", 0.5), (2, None, None), (None, "y", float("nan"))]

    def same(other):
        return rows.same_rows(frame(schema, base), frame(schema, other), exact)

    assert same(base[::-1])
    assert not same(base + base[:1])
    assert not same(base[1:])
    assert not same([(1, "x", 0.25), *base[1:]])


def test_moved_value_is_a_difference(frame):
    schema = "a string, b string"
    assert not rows.same_rows(frame(schema, [("x", None)]), frame(schema, [(None, "x")]), exact=False)
    assert not rows.same_rows(frame(schema, [("ab", "c")]), frame(schema, [("a", "bc")]), exact=False)


def test_negative_zero_equals_zero(frame):
    assert rows.same_rows(frame("a double", [(0.0,)]), frame("a double", [(-0.0,)]))


def test_diff(frame):
    src, tgt = frame("k int, v string", [(1, "a"), (2, "b"), (3, None)]), frame("k int, v string", [(2, "x"), (3, None), (4, "d")])
    assert values(rows.diff_rows(src, tgt, ["k"])) == [(1, "missing"), (2, "changed"), (4, "extra")]


def test_high_water_mark(frame):
    assert rows.high_water_mark(frame("c long", []), "c") == 0
    assert rows.high_water_mark(frame("c long", [(3,), (None,)]), "c") == 3


def test_layout_sort_keeps_partitions(spark):
    df = rows.sort_for_layout(spark.range(100).repartition(4), ["id"])
    parts = df.withColumn("p", F.spark_partition_id()).collect()
    for p in range(4):
        ids = [r.id for r in parts if r.p == p]
        assert ids == sorted(ids)


def test_ids_are_dense_and_continue(spark):
    df = spark.range(1000).repartition(7).withColumn("v", F.lit("same"))
    assert sorted(r.id for r in assign_ids(df.select("v"), 41).collect()) == list(range(42, 1042))


def test_ordered_ids_split_a_group_of_equal_rows(spark, without_aqe):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("c")).repartition(5)
    numbered = assign_ids(df, order_by=["c"])
    got = sorted((r.id, r.c) for r in numbered.collect())
    assert [i for i, _ in got] == list(range(1, 3001))
    assert [c for _, c in got] == sorted(c for _, c in got)
    hot = [spark.read.parquet(f).filter("c = 0").count() for f in numbered.inputFiles()]
    assert sum(hot) == 1000 and max(hot) < 1000


@pytest.mark.parametrize("order", [[], ["id"]])
def test_ids_leave_one_copy(spark, tmp_path, order):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    numbered = assign_ids(spark.range(100).withColumnRenamed("id", "v"), 0, ["v"] if order else [], str(tmp_path))
    assert numbered.count() == 100
    assert len(list(tmp_path.iterdir())) == 1 and set(shared.iterdir()) == before


def test_ids_of_nothing(frame):
    assert assign_ids(frame("a int", [])).count() == 0


RULES = Rules(not_null=["k"], max_length={"v": 255}, unique=["k"])


def test_violations(frame):
    df = frame("k string, v string", [("a", "x" * 256), ("b", None), ("b", "y"), (None, "x" * 255)])
    assert quality.violations(df, RULES) == {"k is null": 1, "v is longer than 255": 1, "k is repeated": 2}
    with pytest.raises(RuleViolation, match="k is null: 1 rows"):
        quality.enforce(df, RULES)


def test_quarantine(frame):
    df = frame("k string, v string", [("a", "x" * 256), ("b", None), ("b", "y"), (None, "z"), ("c", "fine")])
    good, bad = quality.enforce(df, RULES, "quarantine")
    assert values(good) == [("c", "fine")]
    assert sorted(r.reason for r in bad.collect()) == [
        "k is null",
        "k is repeated",
        "k is repeated",
        "v is longer than 255",
    ]


def test_taken(frame):
    assert values(quality.taken(frame("k int", [(1,), (1,), (2,)]), frame("k int", [(2,), (3,)]), ["k"])) == [(2,)]


def test_overflow_raises(frame):
    from pyspark.sql import types as T

    from tidemark.functions.scalars import conform

    with pytest.raises(PySparkException):
        conform(frame("n double", [(3e10,)]), T.StructType([T.StructField("n", T.IntegerType())])).collect()


def test_timestamps_hash(frame):
    df = frame("t timestamp_ntz", [(datetime(2020, 1, 1),), (None,)])
    assert rows.same_rows(df, df)
