"""The physical plans a cluster would run: ERP tables as parquet files, no side small enough to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from adapters.tpch import SOURCES
from tests.conftest import SF_DIR
from tidemark.operators import loads
from tidemark.operators.rows import same_rows
from tidemark.plans.catalog import DATASETS
from tidemark.plans.model import Inputs
from tidemark.sources.profiles import Profile, reader


@pytest.fixture(scope="module")
def erp(spark, tmp_path_factory):
    """All source tables but the suppliers' partner table, written as parquet; read through a profile."""
    from adapters.tpch import spark_source

    root = tmp_path_factory.mktemp("erp")
    read = spark_source(spark, SF_DIR)
    for name in SOURCES:
        read(name).write.parquet(f"{root}/{name}")
    return Inputs(spark, reader(spark, Profile("parquet", location=f"{root}/{{table}}")))


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.tidemark.broadcast.maxBytes": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan(plan: str, table: str) -> str:
    return next(line for line in plan.splitlines() if "FileScan" in line and f"/{table}]" in line)


@pytest.mark.parametrize("name", [n for n in DATASETS if n != "Date"])
def test_no_pairwise_join_and_no_single_task_shuffle(erp, no_broadcast, name):
    plan = _plan(DATASETS[name].build(erp))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "PythonUDF", "ArrowEval"):
        assert node not in plan


@pytest.mark.parametrize("name", ["SALESORDER", "PORDER"])
def test_lines_are_shuffled_once_for_both_joins(erp, no_broadcast, name):
    assert _plan(DATASETS[name].build(erp)).count("Exchange hashpartitioning") == 3


def test_customer_look_ups_need_no_shuffle_of_customers(erp):
    plan = _plan(DATASETS["BPCUSTOMER"].build(erp))
    assert plan.count("BroadcastHashJoin") == 8


def test_cursor_filter_and_columns_reach_the_line_scan(erp, no_broadcast):
    ds = DATASETS["SALESINVOICE"]
    plan = _plan(loads.append_above(ds.build(erp), 1000, ds.cursor))
    lines = _scan(plan, "SINVOICED")
    assert re.search(r"PushedFilters: \[.*Or\(GreaterThan\(ROWID,1000\),IsNull\(ROWID\)\)", lines)
    assert "LINE_0" not in lines


@pytest.mark.parametrize("name", ["SALESQUOTE", "SALESORDER", "SDELIVERY", "SALESINVOICE", "PORDER", "PRECEIPT"])
def test_increment_gives_the_rows_above_the_mark(erp, name):
    """Without broadcast of whole tables: every table without the cursor is cut down by a broadcast of new numbers."""
    ds = DATASETS[name]
    whole = ds.build(erp)
    mark = whole.agg((F.max(ds.cursor) * 0.99).cast("long")).first()[0]
    part = ds.build(erp.increment(ds.cursor_table, mark))
    expected = loads.append_above(whole, mark, ds.cursor)
    assert part.count() > 0
    assert same_rows(part, expected)
    others = 2 if name in ("SALESORDER", "PORDER") else 1
    assert _plan(part).count("LeftSemi, BuildRight") == others


class Pushing:
    """Stands for a database: a source that cuts its tables down itself, and notes what it gives."""

    pushes = True

    def __init__(self, read):
        self.read, self.given = read, []

    def __call__(self, table):
        self.given.append((table, "whole"))
        return self.read(table)

    def above(self, table, cursor, mark):
        self.given.append((table, "above"))
        return self.read(table).filter(F.col(cursor) > mark)

    def related(self, table, number, new, cursor, mark):
        self.given.append((table, "related"))
        numbers = self.read(new).filter(F.col(cursor) > mark).select(number)
        return self.read(table).join(numbers, number, "left_semi")


@pytest.mark.parametrize("name", ["SALESQUOTE", "SALESORDER", "SDELIVERY", "SALESINVOICE", "PORDER", "PRECEIPT"])
def test_a_database_gives_the_rows_of_new_documents_only(spark, erp, tmp_path, name):
    ds = DATASETS[name]
    whole = ds.build(erp)
    mark = whole.agg((F.max(ds.cursor) * 0.99).cast("long")).first()[0]
    read = Pushing(erp._read)
    part = ds.build(Inputs(spark, read, land=str(tmp_path)).increment(ds.cursor_table, mark, ds.number))
    assert same_rows(part, loads.append_above(whole, mark, ds.cursor))
    assert read.given[0] == (ds.cursor_table, "above")
    look_ups = {"YREPRE"} if name in ("SALESQUOTE", "SALESINVOICE") else set()
    assert {t for t, how in read.given if how == "whole"} == look_ups
    assert len(read.given) == len(set(read.given))


@pytest.mark.parametrize("name", ["BPCUSTOMER", "BPSUPPLIER", "ITMMASTER", "SALESREP"])
def test_partner_increment(erp, name):
    ds = DATASETS[name]
    part = ds.build(erp.increment(ds.cursor_table, 90))
    assert same_rows(part, loads.append_above(ds.build(erp), 90, ds.cursor))


def test_header_cursor_filter_reaches_the_header_scan(erp, no_broadcast):
    ds = DATASETS["SDELIVERY"]
    plan = _plan(loads.append_above(ds.build(erp), 1000, ds.cursor))
    assert "GreaterThan(ROWID,1000)" in _scan(plan, "SDELIVERY")


def test_time_type_filter_reaches_the_scan(erp):
    assert "EqualTo(TIMTYP_0,1)" in _scan(_plan(DATASETS["SUIVITEMPSOF"].build(erp)), "MFGOPETRK")


def test_dictionary_filters_reach_the_scan(spark, erp):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(DATASETS["ITMMASTER"].build(erp))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    lines = [x for x in plan.splitlines() if "FileScan" in x and "ATEXTRA" in x]
    assert lines
    for line in lines:
        pushed = line.split("PushedFilters")[1]
        assert "EqualTo(LANGUE_0,FRA)" in pushed and "StringContains(ZONE_0,LNGDES)" in pushed


def test_distinct_capacity_shuffles_stations_not_days(erp, no_broadcast):
    after_days = _plan(DATASETS["POSTEDECHARGE"].build_distinct(erp)).split("Generate explode(CASE WHEN")[0]
    assert "Exchange" not in after_days


def test_landed_tables_give_the_same_rows(spark, erp, tmp_path):
    landed = erp.landed(str(tmp_path))
    for name in DATASETS:
        if name not in ("Date", "POSTEDECHARGE"):
            assert same_rows(DATASETS[name].build(landed), DATASETS[name].build(erp), exact=False)
