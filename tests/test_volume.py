"""What moves rows moves no more than it must: tasks that read evenly, few copies, small files."""

from __future__ import annotations

import re
import time
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from adapters import queries
from tests.conftest import SF_DIR, values
from tidemark.operators import rows
from tidemark.operators.keys import assign_ids
from tidemark.plans import partners
from tidemark.session import FREE_SHUFFLES, SKEW_MIN_ROWS, shared_dir, stage


def test_rows_in_another_order_are_dealt_to_all_tasks(spark, without_aqe, monkeypatch):
    """The comparison's second side takes as many tasks as the session has, however many articles there are."""
    seen = []
    monkeypatch.setattr(queries.rows, "same_rows", lambda a, b: not seen.append(b))
    queries.e4_same(spark, SF_DIR)
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_compared_invoices_are_joined_once(spark, monkeypatch):
    """All three evaluations of the invoices read one stored copy."""
    seen = []
    monkeypatch.setattr(queries.rows, "same_rows", lambda a, b: not seen.extend([a, b]))
    queries.e4_same(spark, SF_DIR)
    assert len(seen) == 4 and len({frozenset(df.inputFiles()) for df in seen}) == 1
    assert all(f.split(":", 1)[1].lstrip("/").startswith(shared_dir(spark).lstrip("/")) for f in seen[0].inputFiles())


def _watched(monkeypatch):
    """The buckets that a comparison takes for hot, and the frame in which it counts rows."""
    asked, original = [], rows.signed_counts

    def counts(a, b, hot=None, tasks=0):
        asked.append((hot, found := original(a, b, hot, tasks)))
        return found

    monkeypatch.setattr(rows, "signed_counts", counts)
    return asked


def test_an_order_given_before_is_not_shuffled_to_count_rows(spark, frame, without_aqe, monkeypatch):
    """The exact comparison deals the rows once, not once for their order and twice to count them."""
    df = stage(frame("k int, v string, x double", [(i, str(i % 7), i / 3) for i in range(500)]))
    asked = _watched(monkeypatch)
    assert rows.same_rows(df, df.repartition("v", "k"))
    plan = asked[-1][1]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) == plan.count("ReusedExchange") + 1 == 2


def test_many_rows_are_dealt_to_more_tasks_than_the_session_has(spark, frame, monkeypatch):
    """A task counts no more rows than fit its memory, however few tasks the session has."""
    monkeypatch.setattr(rows, "TASK_ROWS", 10)
    df = stage(frame("k int, v string, x double", [(i, str(i % 7), i / 3) for i in range(500)]))
    asked = _watched(monkeypatch)
    assert rows.same_rows(df, df.repartition("v"))
    assert "50), REPARTITION_BY_NUM" in asked[-1][1]._jdf.queryExecution().executedPlan().toString()


def test_many_copies_of_a_row_are_added_up_before_the_shuffle(spark, frame, monkeypatch):
    """Their bucket alone is told apart, and counts as much as the others."""
    schema, one = "k int, v string, x double", (1, "same", -0.0)
    some = [(i, None if i % 3 else "v", float("nan") if i % 5 else i / 3) for i in range(300)]
    a, b = frame(schema, [one] * 600 + some), frame(schema, some[::-1] + [(1, "same", 0.0)] * 600)
    off = frame(schema, [one] * 599 + some + some[:1])
    spark.conf.set(SKEW_MIN_ROWS[0], "10")
    try:
        asked = _watched(monkeypatch)
        assert rows.same_rows(a, b)
        hot = asked[-1][0]
        assert len(hot) == 1
        for buckets in ([], hot, list(range(0, rows.BUCKETS, 2))):
            assert values(rows.signed_counts(a, off, buckets)) == values(rows.signed_counts(a, off))
            assert sorted(r.surplus for r in rows.signed_counts(a, off, buckets).collect()) == [-1, 1]
            assert rows.signed_counts(a, b, buckets).isEmpty()
    finally:
        spark.conf.unset(SKEW_MIN_ROWS[0])


def test_unlike_types_and_no_rows_are_compared(frame):
    few, wide = frame("k int, v string", [(1, "a"), (2, None)]), frame("v string, k long", [(None, 2), ("a", 1)])
    assert rows.same_rows(few, wide) and not rows.same_rows(few, wide.filter("k > 1"))
    assert rows.same_rows(few.limit(0), wide.limit(0)) and not rows.same_rows(few, wide.limit(0))


def test_a_comparison_leaves_no_shuffle_on_disk(spark, frame):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = disk.getAllFiles()
        return {files.apply(i).getPath() for i in range(files.size()) if "shuffle_" in files.apply(i).getName()}

    before, setting = held(), spark.conf.get(FREE_SHUFFLES)
    df = frame("k int, v string", [(i, "v") for i in range(500)])
    assert rows.same_rows(df, df.repartition("k"))
    for _ in range(40):
        if not (left := held() - before):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(FREE_SHUFFLES) == setting


def test_buckets_are_written_once(spark, frame, house, monkeypatch):
    """The first load of a table in buckets writes its rows to one staged copy and to their folder, ids without a gap."""
    monkeypatch.setattr(DataFrameWriter, "parquet", _counted(written := Counter(), DataFrameWriter.parquet))
    spark.conf.set("spark.tidemark.bucket.rows", "50")
    try:
        source = frame("REPNUM_0 string, REPNAM_0 string, ROWID long", [(str(i), f"name {i}", i + 1) for i in range(300)])
        warehouse = house({"SALESREP": source})
        warehouse.create("SALESREP")
        assert warehouse.load("SALESREP").inserted == 300
    finally:
        spark.conf.unset("spark.tidemark.bucket.rows")
    assert sum(written.values()) == 2
    stored = warehouse.store.read(partners.SALESREP, with_id=True)
    assert sorted(r.id for r in stored.select("id").collect()) == list(range(1, 301))
    _, folders = warehouse.store.state(partners.SALESREP)
    assert {f.buckets for f in folders} == {8}
    assert values(stored.drop("id")) == values(source)


def _counted(written, original):
    def parquet(self, path, *args, **kwargs):
        if not path.endswith("/_index"):
            written[tuple(self._df.columns)] += 1
        return original(self, path, *args, **kwargs)

    return parquet


def test_numbered_rows_stand_in_small_files(spark, frame):
    """A group of equal rows is still numbered without a gap; its copy is packed by zstd."""
    df = frame("k int, v string", [(i % 3, "same") for i in range(900)])
    numbered = assign_ids(df, order_by=["k"])
    assert all(".zstd." in name for name in numbered.inputFiles())
    assert [r.k for r in numbered.orderBy("id").collect()] == sorted(i % 3 for i in range(900))
    assert sorted(r.id for r in numbered.collect()) == list(range(1, 901))
