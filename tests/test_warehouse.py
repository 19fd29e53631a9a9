"""Whole loads into a stored table."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from tests.conftest import values
from tidemark.plans.catalog import DATASETS
from tidemark.plans.catalog import CALENDAR
from tidemark.plans.partners import COMPANY
from tidemark.plans.shopfloor import CAPACITY, PRODUCTION
from tidemark.session import BROADCAST_BYTES
from tidemark.sources.profiles import Profile
from tidemark.sources.store import Folder, added_up, to_compact
from tidemark.warehouse import LoadFailed, LoadReport, Warehouse

COMPANY_ROWS = "CPY_0 string, CPYNAM_0 string, ROWID long"
TRACK = "MFGTRKNUM_0 string, ITMREF_0 string, MFGFCY_0 string, CPLQTY_0 double, IPTDAT_0 timestamp_ntz"


def _t(month, day=1):
    return datetime(2024, month, day)


@pytest.fixture
def company(frame, house):
    tables = {}
    warehouse = house(tables)
    warehouse.create("COMPANY")

    def give(*rows):
        tables["COMPANY"] = frame(COMPANY_ROWS, list(rows))
        return warehouse

    return give


def test_create_reports_created_then_exists(house):
    warehouse = house({})
    assert warehouse.create("COMPANY").outcome == "created"
    assert warehouse.create("COMPANY").outcome == "exists"
    assert warehouse.store.read(COMPANY).count() == 0


def test_loading_a_table_that_was_not_created(house, frame):
    with pytest.raises(FileNotFoundError):
        house({"COMPANY": frame(COMPANY_ROWS, [])}).load("COMPANY")


def test_first_load_takes_positive_cursors_only(company):
    warehouse = company(("A", "a", -1), ("B", "b", 0), ("C", "c", 1))
    assert warehouse.load("COMPANY") == LoadReport("COMPANY", "loaded", 1)
    assert values(warehouse.store.read(COMPANY)) == [("C", "c", 1)]


def test_later_load_appends_above_the_mark_and_ids_go_on(company):
    company(("A", "a", 5)).load("COMPANY")
    warehouse = company(("A", "changed", 5), ("B", "b", 6), ("C", "c", 4))
    assert warehouse.load("COMPANY").inserted == 1
    assert warehouse.load("COMPANY") == LoadReport("COMPANY", "nothing new")
    assert values(warehouse.store.read(COMPANY, with_id=True)) == [(1, "A", "a", 5), (2, "B", "b", 6)]


def test_clear_starts_over(company):
    company(("A", "a", 5)).load("COMPANY")
    warehouse = company(("B", "b", 1))
    assert warehouse.load("COMPANY", clear=True).inserted == 1
    assert values(warehouse.store.read(COMPANY, with_id=True)) == [(1, "B", "b", 1)]


@pytest.mark.parametrize(
    ("row", "message"),
    [
        (("A", "again", 9), "already in the table"),
        (("B" * 256, "long", 9), "longer than 255"),
        (("B", "no cursor", None), "ROWID is null"),
    ],
)
def test_one_bad_row_rejects_the_load(company, row, message):
    company(("A", "a", 5)).load("COMPANY")
    warehouse = company(("C", "good", 8), row)
    with pytest.raises(LoadFailed, match=message) as failure:
        warehouse.load("COMPANY")
    assert failure.value.report.outcome == "failed"
    assert values(warehouse.store.read(COMPANY)) == [("A", "a", 5)]


def test_a_unique_column_holds_one_null(company):
    warehouse = company(("A", "a", 5), (None, "b", 6))
    assert warehouse.load("COMPANY").inserted == 2
    with pytest.raises(LoadFailed, match="already in the table"):
        company((None, "c", 7)).load("COMPANY")


def test_replace_takes_rows_without_cursor(company):
    warehouse = company(("A", "a", None), ("B", "b", 3))
    assert warehouse.sync("COMPANY").inserted == 2
    assert company(("C", "c", 4), ("D", "d", 3)).load("COMPANY").inserted == 1


def test_publish_writes_stored_rows_with_ids(company, spark, tmp_path):
    warehouse = company(("A", "a", 5))
    warehouse.load("COMPANY")
    warehouse.publish("COMPANY", Profile("parquet", location=f"{tmp_path}/out/{{table}}"))
    assert values(spark.read.parquet(f"{tmp_path}/out/COMPANY")) == [(1, "A", "a", 5)]


def test_repeated_key_in_one_batch(company):
    with pytest.raises(LoadFailed, match="repeated"):
        company(("A", "a", 5), ("A", "b", 6)).load("COMPANY")


def test_replace_drops_what_the_source_lost_and_restarts_ids(company):
    company(("A", "a", 5), ("B", "b", 6)).load("COMPANY")
    warehouse = company(("B", "new", 6), ("Z", "z", -3))
    assert warehouse.sync("COMPANY") == LoadReport("COMPANY", "loaded", 2)
    assert values(warehouse.store.read(COMPANY)) == [("B", "new", 6), ("Z", "z", -3)]
    assert sorted(r.id for r in warehouse.store.read(COMPANY, with_id=True).collect()) == [1, 2]
    version, _ = warehouse.store.state(COMPANY)
    assert warehouse.sync("COMPANY").outcome == "in step"
    assert warehouse.store.state(COMPANY)[0] == version


def test_old_readers_keep_their_rows(company):
    warehouse = company(("A", "a", 5))
    warehouse.load("COMPANY")
    before = warehouse.store.read(COMPANY)
    company(("B", "b", 6)).sync("COMPANY")
    assert values(before) == [("A", "a", 5)]


def test_of_two_writers_one_fails(company):
    warehouse = company(("A", "a", 5))
    version, folders = warehouse.store.state(COMPANY)
    warehouse.store.commit(COMPANY, version, folders)
    with pytest.raises(Exception, match="[Ee]xist"):
        warehouse.store.commit(COMPANY, version, [Folder("data/other")])


@pytest.fixture
def production(frame, house):
    tables = {"FACILITY": frame("FCY_0 string, LEGCPY_0 string", [("S", "C0")])}
    warehouse = house(tables)
    warehouse.create("PRODUCTION")

    def give(*rows):
        tables["MFGITMTRK"] = frame(TRACK, [(n, "A", "S", q, d) for n, q, d in rows])
        return warehouse

    return give


def _stored(warehouse):
    return values(warehouse.store.read(PRODUCTION).select("numerosuivi", "quantiterealise", "daterealisation"))


def test_insert_keeps_the_first_version(production):
    warehouse = production(("1", 5.0, _t(2)), ("1", 4.0, _t(1)), ("2", 1.0, _t(1)))
    assert warehouse.load("PRODUCTION").inserted == 2
    warehouse = production(("1", 9.0, _t(3)), ("3", 1.0, _t(3)))
    assert warehouse.load("PRODUCTION").inserted == 1
    assert warehouse.load("PRODUCTION").outcome == "nothing new"
    assert _stored(warehouse) == [("1", 4.0, _t(1)), ("2", 1.0, _t(1)), ("3", 1.0, _t(3))]


@pytest.mark.parametrize("small", ["1000000", "-1"])
def test_insert_of_few_and_of_many_keys(production, spark, small):
    production(("1", 5.0, _t(1))).load("PRODUCTION")
    warehouse = production(("1", 9.0, _t(3)), ("2", 2.0, _t(2)), ("2", 1.0, _t(1)), ("3", 1.0, _t(3)))
    old = spark.conf.get(BROADCAST_BYTES[0])
    spark.conf.set(BROADCAST_BYTES[0], small)
    try:
        assert warehouse.load("PRODUCTION").inserted == 2
    finally:
        spark.conf.set(BROADCAST_BYTES[0], old)
    assert _stored(warehouse) == [("1", 5.0, _t(1)), ("2", 1.0, _t(1)), ("3", 1.0, _t(3))]


def test_null_key_rejects_an_insert(production):
    with pytest.raises(LoadFailed, match="numerosuivi is null"):
        production((None, 5.0, _t(2))).load("PRODUCTION")
    production(("1", 5.0, _t(1))).load("PRODUCTION")
    with pytest.raises(LoadFailed, match="numerosuivi is null"):
        production(("1", 5.0, _t(1)), (None, 5.0, _t(2))).load("PRODUCTION")


def test_merge_keeps_the_last_version_and_target_only_rows(production):
    production(("1", 5.0, _t(1)), ("2", 1.0, _t(1)), ("3", 1.0, _t(6))).load("PRODUCTION")
    warehouse = production(("1", 7.0, _t(4)), ("1", 6.0, _t(2)), ("2", 1.0, _t(1)), ("4", 1.0, _t(4)))
    assert warehouse.sync("PRODUCTION") == LoadReport("PRODUCTION", "loaded", 1, 3)
    assert _stored(warehouse) == [("1", 7.0, _t(4)), ("2", 1.0, _t(1)), ("3", 1.0, _t(6)), ("4", 1.0, _t(4))]


def test_merge_leaves_untouched_months_alone(production):
    production(("1", 5.0, _t(1)), ("3", 1.0, _t(6))).load("PRODUCTION")
    warehouse = production(("1", 7.0, _t(1)), ("3", 1.0, _t(6)))
    june = {f for f in warehouse.store.state(PRODUCTION)[1] if f.month == 2024 * 12 + 6}
    warehouse.sync("PRODUCTION")
    folders = set(warehouse.store.state(PRODUCTION)[1])
    assert june <= folders and len(folders) == 2
    assert warehouse.sync("PRODUCTION").outcome == "in step"


def test_merge_with_a_bad_row_changes_nothing(production):
    production(("1", 5.0, _t(1))).load("PRODUCTION")
    warehouse = production(("1", 6.0, _t(1)), ("2", None, _t(1)))
    with pytest.raises(LoadFailed, match="quantiterealise is null"):
        warehouse.sync("PRODUCTION")
    assert _stored(warehouse) == [("1", 5.0, _t(1))]


WEEKS = "TWD_0 string, " + ", ".join(f"DAYCAP_{i} double" for i in range(7))


@pytest.fixture
def capacity(frame, house):
    tables = {"FACILITY": frame("FCY_0 string, LEGCPY_0 string", [("S", "C0")])}
    warehouse = house(tables, date(2016, 2, 2))
    warehouse.create("POSTEDECHARGE")

    def give(*stations, hours=1.0):
        tables["WORKSTATIO"] = frame("WST_0 string, TWD_0 string, WSTDES_0 string, WCRFCY_0 string", list(stations))
        tables["TABWEEDIA"] = frame(WEEKS, [("W", *[hours] * 7), (None, *[2.0] * 7)])
        return warehouse

    return give


def test_load_all_twice_doubles_the_rows(capacity):
    warehouse = capacity(("P", "W", "one", "S"), ("P", "W", "one", "S"))
    assert warehouse.load("POSTEDECHARGE").inserted == 33
    assert warehouse.load("POSTEDECHARGE").inserted == 33
    assert warehouse.store.read(CAPACITY).count() == 66
    assert warehouse.load("POSTEDECHARGE", clear=True).inserted == 33
    assert warehouse.store.read(CAPACITY).count() == 33


def test_rows_that_break_a_rule_are_set_aside(capacity):
    warehouse = capacity(("P", "W", "one", "S"), ("Q" * 51, "W", "two", "S"))
    report = warehouse.load("POSTEDECHARGE")
    assert (report.inserted, report.quarantined) == (33, 33)
    assert {r.poste for r in warehouse.store.read(CAPACITY).collect()} == {"P"}
    rejected = warehouse.store.quarantine(CAPACITY)
    assert {(r.poste, r.reason) for r in rejected.collect()} == {("Q" * 51, "poste is longer than 50")}


def test_upsert_updates_inserts_and_keeps(capacity):
    capacity(("P", "W", "one", "S"), ("old", "W", "gone", "S")).load("POSTEDECHARGE")
    warehouse = capacity(("P", "W", "renamed", "S"), ("N", "W", "new", "S"), hours=3.0)
    assert warehouse.sync("POSTEDECHARGE") == LoadReport("POSTEDECHARGE", "loaded", 33, 33)
    found = {(r.poste, r.designationPoste, r.tempstheorique) for r in warehouse.store.read(CAPACITY).collect()}
    assert found == {("P", "renamed", 3.0), ("old", "gone", 1.0), ("N", "new", 3.0)}
    assert warehouse.sync("POSTEDECHARGE").outcome == "in step"


def test_upsert_inserts_null_keys_on_every_run(capacity):
    warehouse = capacity(("P", None, "one", "S"))
    warehouse.sync("POSTEDECHARGE")
    warehouse.sync("POSTEDECHARGE")
    assert warehouse.store.read(CAPACITY).count() == 66


def test_calendar_adds_only_new_days(house):
    warehouse = house({}, date(2013, 1, 10))
    warehouse.create("Date")
    assert warehouse.load("Date").inserted == 10
    later = house({}, date(2013, 1, 12))
    assert later.load("Date").inserted == 2
    assert later.load("Date").outcome == "nothing new"
    assert sorted(r.id for r in later.view("Date").collect()) == list(range(1, 13))
    assert later.store.read(CALENDAR).count() == 12
    with pytest.raises(ValueError):
        later.sync("Date")


def test_export_keeps_null_fields(company, tmp_path):
    company(("A", None, 1)).export("COMPANY", str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"CPY_0": "A", "CPYNAM_0": None, "ROWID": 1}]


def test_landing_reads_each_source_once(frame, spark, tmp_path):
    reads = []
    tables = {
        "FACILITY": frame("FCY_0 string, LEGCPY_0 string, more int", [("S", "C0", 1)]),
        "MFGITMTRK": frame(TRACK + ", more int", [("1", "A", "S", 1.0, _t(1), 5)]),
    }

    def read(name):
        reads.append(name)
        return tables[name]

    warehouse = Warehouse(spark, str(tmp_path / "landed"), read, land=True)
    warehouse.create("PRODUCTION")
    assert warehouse.load("PRODUCTION").inserted == 1
    assert sorted(reads) == ["FACILITY", "MFGITMTRK"]
    assert warehouse.load("PRODUCTION").outcome == "nothing new"
    assert warehouse.sync("PRODUCTION").outcome == "in step"
    assert _stored(warehouse) == [("1", 1.0, _t(1))]


def test_landing_an_append_copies_only_rows_above_the_mark(frame, spark, tmp_path):
    tables = {"COMPANY": frame(COMPANY_ROWS, [("A", "a", 1)])}
    warehouse = Warehouse(spark, str(tmp_path / "landed"), tables.__getitem__, land=True)
    warehouse.create("COMPANY")
    warehouse.load("COMPANY")
    tables["COMPANY"] = frame(COMPANY_ROWS, [("A", "changed", 1), ("B", "b", 2)])
    assert warehouse.load("COMPANY").inserted == 1
    assert warehouse.sync("COMPANY") == LoadReport("COMPANY", "loaded", 2)


def test_staged_copies_are_removed(company, spark):
    from pathlib import Path

    warehouse = company(("A", "a", 1))
    warehouse.load("COMPANY")
    warehouse.sync("COMPANY")
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("load-*"))


def test_loads_of_one_warehouse_run_side_by_side(spark, sources, house):
    from concurrent.futures import ThreadPoolExecutor

    names = ["SALESINVOICE", "ITMMASTER", "COMPANY", "SALESREP"]
    all_of = house(type("Tables", (dict,), {"__missing__": lambda _, n: sources(n)})())
    for n in names:
        all_of.create(n)
    with ThreadPoolExecutor(4) as pool:
        reports = list(pool.map(all_of.load, names))
    for n, report in zip(names, reports):
        assert report.inserted == all_of.build(n).count() == all_of.store.read(DATASETS[n]).count()


def test_overwrite_and_append_keep_cursor_and_count(spark, sources, house):
    one = house(type("Tables", (dict,), {"__missing__": lambda _, n: sources(n)})())
    one.create("SALESREP")
    one.load("SALESREP")
    ds = DATASETS["SALESREP"]
    held = one.store.read(ds, with_id=True)
    rows = held.count()
    one.store.overwrite(ds, held)
    assert one.load("SALESREP").outcome == "nothing new"
    one.store.overwrite(ds, held.filter("id <= 3"))
    one.load("SALESREP")
    ids = [r.id for r in one.store.read(ds, with_id=True).collect()]
    assert len(set(ids)) == len(ids) <= rows


def test_a_commit_race_is_a_failed_load(spark, sources, house, monkeypatch):
    one = house(type("Tables", (dict,), {"__missing__": lambda _, n: sources(n)})())
    one.create("SALESREP")
    put = one.store._put
    monkeypatch.setattr(one.store, "_put", lambda ds, version, folders: [put(ds, version, folders) for _ in range(2)])
    with pytest.raises(LoadFailed, match="another writer committed first"):
        one.load("SALESREP")


def test_vacuum_frees_replaced_rows_only(company):
    warehouse = company(("A", "a", 1))
    for rows in [[("A", "a", 1)], [("A", "b", 1)], [("A", "c", 1), ("B", "d", 2)]]:
        company(*rows).sync("COMPANY")
    before = values(warehouse.store.read(COMPANY))
    warehouse.store.write(COMPANY, warehouse.store.read(COMPANY, with_id=True))
    assert warehouse.vacuum("COMPANY") == 0
    assert warehouse.vacuum("COMPANY", keep=1, hours=0) == 3
    assert values(warehouse.store.read(COMPANY)) == before == [("A", "c", 1), ("B", "d", 2)]
    assert warehouse.vacuum("COMPANY", keep=1, hours=0) == 0
    assert company(("C", "e", 3)).load("COMPANY").inserted == 1
    with pytest.raises(ValueError):
        warehouse.vacuum("COMPANY", keep=0)


def test_vacuum_of_months(production):
    warehouse = production(("1", 1.0, _t(1)), ("2", 2.0, _t(2)))
    warehouse.sync("PRODUCTION")
    warehouse = production(("1", 5.0, _t(1)))
    warehouse.sync("PRODUCTION")
    before = values(warehouse.store.read(PRODUCTION))
    assert warehouse.vacuum("PRODUCTION", keep=1, hours=0) == 1
    assert values(warehouse.store.read(PRODUCTION)) == before and len(before) == 2


def test_small_folders_are_packed_so_that_every_row_moves_to_a_larger_one():
    folder = lambda rows, month=None, **more: Folder(f"data/{rows}-{month}", month=month, rows=rows, **more)
    names = lambda groups: [sorted(f.rows for f in g) for g in groups]
    assert names(to_compact([folder(1), folder(2), folder(3), folder(90), folder(100)], 100)) == [[1, 2, 3]]
    assert names(to_compact([folder(n) for n in (40, 41, 42, 43, 44, 45, 46)], 100)) == [[40, 41, 42], [43, 44, 45]]
    assert to_compact([folder(99), folder(1), folder(500)], 100) == to_compact([], 100) == to_compact([folder(None)], 100) == []
    held = [folder(7, month=1), folder(8, month=1), folder(5, month=2), folder(6, month=-1), folder(9, month=-1)]
    assert names(to_compact([*held, folder(1, bucket=0, buckets=1), folder(4, month=3), folder(4, month=3)], 100)) == [[4, 4, 7, 8]]


def test_compaction_keeps_rows_ids_cursor_and_fingerprints(company):
    for i in range(1, 7):
        warehouse = company(*[(f"C{n}", f"name {n}", n) for n in range(1, 2 * i + 1)])
        warehouse.load("COMPANY")
    before, reader = values(warehouse.store.read(COMPANY, with_id=True)), warehouse.store.read(COMPANY)
    _, old = warehouse.store.state(COMPANY)
    assert warehouse.compact("COMPANY") == 4 and warehouse.compact("COMPANY") == 0
    _, folders = warehouse.store.state(COMPANY)
    assert added_up(folders) == added_up(old) and max(f.cursor for f in folders) == 12
    assert values(warehouse.store.read(COMPANY, with_id=True)) == before and len(values(reader)) == 12
    assert warehouse.load("COMPANY").outcome == "nothing new" and warehouse.sync("COMPANY").outcome == "in step"
    company(("C3", "again", 13))
    with pytest.raises(LoadFailed, match="already in the table"):
        warehouse.load("COMPANY")
    company(("new", "new", 14)).load("COMPANY")
    assert values(warehouse.store.read(COMPANY, with_id=True))[4] == (13, "new", "new", 14)
    assert warehouse.vacuum("COMPANY", keep=1, hours=0) == 5


def test_compaction_by_month_and_set_aside_rows(capacity):
    warehouse = capacity(("P", "W", "one", "S"), ("Q" * 51, "W", "two", "S"))
    for _ in range(3):
        warehouse.load("POSTEDECHARGE")
    before, aside = values(warehouse.store.read(CAPACITY)), values(warehouse.store.quarantine(CAPACITY))
    _, old = warehouse.store.state(CAPACITY)
    assert warehouse.compact("POSTEDECHARGE") > 0
    _, folders = warehouse.store.state(CAPACITY)
    kept = [f for f in folders if f.month != -1]
    assert len({f.month for f in kept}) == len(kept) < len([f for f in old if f.month != -1])
    assert values(warehouse.store.read(CAPACITY)) == before and values(warehouse.store.quarantine(CAPACITY)) == aside


def test_a_load_that_commits_first_wins_over_compaction(company, monkeypatch):
    for i in range(1, 5):
        warehouse = company(*[(f"C{n}", "x", n) for n in range(1, i + 1)])
        warehouse.load("COMPANY")
    store, write = warehouse.store, warehouse.store.write
    version, folders = store.state(COMPANY)

    def slow(*args, **more):
        store._put(COMPANY, version + 1, folders[:1])
        return write(*args, **more)

    monkeypatch.setattr(store, "write", slow)
    with pytest.raises(LoadFailed, match="another writer committed first"):
        warehouse.compact("COMPANY")
    assert values(store.read(COMPANY)) == [("C1", "x", 1)]
