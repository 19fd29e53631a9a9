from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import profiles
from tidemark.sources.profiles import Profile, hash_predicates, jdbc_options, read_source, reader, write_options


def test_profile_from_environment(monkeypatch):
    monkeypatch.setenv("ERP_URL", "jdbc:sqlserver://host")
    monkeypatch.setenv("ERP_USER", "reader")
    profile = Profile.from_env("ERP", "dbo.{table}")
    assert profile == Profile("jdbc", {"url": "jdbc:sqlserver://host", "user": "reader"}, "dbo.{table}")
    with pytest.raises(KeyError):
        Profile.from_env("OTHER")


def test_jdbc_read_is_split_on_the_cursor():
    profile = Profile("jdbc", {"url": "jdbc:x"}, "dbo.{table}")
    options = jdbc_options(profile, "SINVOICED", (1, 100), "ROWID", 8)
    assert options["dbtable"] == "dbo.SINVOICED"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("ROWID", "1", "101")
    assert options["numPartitions"] == "8"


@pytest.mark.parametrize("bounds", [None, (None, None), (5, 5)])
def test_jdbc_read_without_a_range(bounds):
    assert "partitionColumn" not in jdbc_options(Profile("jdbc"), "FACILITY", bounds, "ROWID", 8)


def test_parquet_profile(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "COMPANY"))
    profile = Profile("parquet", location=f"{tmp_path}/{{table}}")
    assert read_source(spark, profile, "COMPANY", ["id"]).count() == 3
    assert reader(spark, profile)("COMPANY").count() == 3


def test_jdbc_write_keeps_the_table_definition():
    options = write_options(Profile("jdbc", {"url": "jdbc:x", "batchsize": "1000"}, "dbo.{table}"), "COMPANY")
    assert options == {"url": "jdbc:x", "batchsize": "1000", "truncate": "true", "dbtable": "dbo.COMPANY"}


def test_jdbc_increment_is_cut_by_the_database(spark):
    read = reader(spark, Profile("jdbc", {"url": "jdbc:x"}, "dbo.{table}"))
    where = read.related_to("SOHNUM_0", "SORDER", "ROWID", 41)
    assert where == "SOHNUM_0 IN (SELECT SOHNUM_0 FROM dbo.SORDER WHERE ROWID > 41)"
    options = jdbc_options(read.profile, "SORDERQ", None, "", 8, where)
    assert options["dbtable"] == f"(SELECT * FROM dbo.SORDERQ WHERE {where}) part"
    assert read.pushes and not reader(spark, Profile("parquet")).pushes


def test_each_row_meets_one_hash_predicate(spark, frame):
    df = frame("k string", [(None,), (None,), *[(f"D{i}",) for i in range(200)]])
    split = hash_predicates("k", "abs(cast(hash({column}) as bigint))", 8)
    counts = [df.filter(p).count() for p in split]
    assert len(split) == 9 and sum(counts) == 202 and counts[0] == 2 and max(counts[1:]) < 100


def test_parquet_source_with_a_condition(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "T"))
    read = reader(spark, Profile("parquet", location=f"{tmp_path}/{{table}}"))
    assert read("T", "id > 6").count() == 3 and read.above("T", "id", 7).count() == 2


@pytest.fixture
def asked(spark, frame, monkeypatch):
    """``asked(cursors)``: a table T of these cursors that Spark itself answers queries about, and the queries."""
    queries = []

    def answer(session, profile, query):
        queries.append(query)
        return session.sql(query)

    monkeypatch.setattr(profiles, "ask", answer)

    def give(cursors):
        frame("c long", [(c,) for c in cursors]).createOrReplaceTempView("T")
        return queries

    return give


def _gappy(n):
    """Half of the rows in the first thousandth of the range, the rest thinly spread, a few below zero, some twice."""
    rng = random.Random(n)
    return [-5, -3, *range(n // 2), *(rng.randrange(1000 * n) for _ in range(n // 2)), 7, 7]


@pytest.mark.parametrize("n, where", [(40_000, None), (40_000, "c > 100"), (60, None)])
def test_quantiles_split_a_cursor_with_gaps(spark, asked, n, where):
    cursors = _gappy(n) + [None] * 3
    queries = asked(cursors)
    profile = Profile("jdbc", {"url": "jdbc:x"})
    bounds = profiles.cursor_bounds(spark, profile, "T", "c", where)
    split = profiles.quantile_split(spark, profile, "T", "c", 8, bounds, where)
    table = spark.table("T").filter(where) if where else spark.table("T")
    counts = [table.filter(p).count() for p in split]
    assert sum(counts) == table.count() and len(split) <= 8
    assert max(counts) <= 1.5 * table.count() / 8 + 5
    if n > 1000:
        assert any("% " in q for q in queries)
        assert all(f"({where})" in q or where in q for q in queries) if where else True


def test_dense_cursors_keep_even_ranges(spark, asked):
    asked(list(range(1000)))
    profile = Profile("jdbc")
    bounds = profiles.cursor_bounds(spark, profile, "T", "c")
    assert bounds == (0, 999, 1000)
    assert profiles.quantile_split(spark, profile, "T", "c", 8, bounds) is None
    asked([])
    assert profiles.quantile_split(spark, profile, "T", "c", 8, profiles.cursor_bounds(spark, profile, "T", "c")) is None


@pytest.mark.parametrize("points", [[], [5], [1, 2, 3], [-7, 0, 10**12]])
def test_each_cursor_meets_one_range(spark, frame, points):
    near = [p + d for p in points for d in (-1, 0, 1)]
    df = frame("c long", [(c,) for c in [None, 0, -(10**15), 10**15, *near]])
    split = profiles.range_predicates("c", points)
    met = df.select(*[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(split)])
    assert all(sum(r) == 1 for r in met.collect()) and len(split) == len(points) + 1


def test_cursors_in_even_steps_are_sampled_too(spark, asked):
    """All values are odd multiples of 1009: no larger prime divides enough of them."""
    asked([1009 * (2 * i + 1) for i in range(20_000)])
    profile = Profile("jdbc")
    split = profiles.quantile_split(spark, profile, "T", "c", 4, profiles.cursor_bounds(spark, profile, "T", "c"))
    counts = [spark.table("T").filter(p).count() for p in split]
    assert sum(counts) == 20_000 and max(counts) < 6000
