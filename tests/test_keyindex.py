"""Key indexes, stored fingerprints and buckets: what a load need not read, against brute force."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators.rows import multiset_sums
from tidemark.plans.partners import COMPANY
from tidemark.plans.shopfloor import PRODUCTION
from tidemark.sources import keyindex
from tidemark.sources.store import SUMS, added_up
from tidemark.warehouse import BUCKET_ROWS, LoadFailed, LoadReport

COMPANY_ROWS = "CPY_0 string, CPYNAM_0 string, ROWID long"
TRACK = "MFGTRKNUM_0 string, ITMREF_0 string, MFGFCY_0 string, CPLQTY_0 double, IPTDAT_0 timestamp_ntz"


@pytest.fixture
def company(frame, house):
    tables = {}
    warehouse = house(tables)
    warehouse.create("COMPANY")

    def give(rows):
        tables["COMPANY"] = frame(COMPANY_ROWS, list(rows))
        return warehouse

    return give


@pytest.fixture
def production(frame, house):
    tables = {"FACILITY": frame("FCY_0 string, LEGCPY_0 string", [("S", "C0")])}
    warehouse = house(tables)
    warehouse.create("PRODUCTION")

    def give(rows):
        tables["MFGITMTRK"] = frame(TRACK, [(n, "A", "S", 1.0, datetime(2024, m, 1)) for n, m in rows])
        return warehouse

    return give


@pytest.fixture
def reads(monkeypatch):
    """The folders that are read, by path, in the order of reading."""
    from tidemark.sources.store import Store

    seen, read = [], Store.read_folders

    def noted(self, ds, folders):
        seen.extend(f.path for f in folders)
        return read(self, ds, folders)

    monkeypatch.setattr(Store, "read_folders", noted)
    return seen


@pytest.fixture
def small_buckets(spark):
    spark.conf.set(BUCKET_ROWS[0], "20")
    yield
    spark.conf.unset(BUCKET_ROWS[0])


def _wanted(warehouse, frame, keys):
    path = f"{warehouse.store.root}/wanted-{random.random()}"
    frame("numerosuivi string", [(k,) for k in keys]).write.parquet(path)
    return warehouse.store.spark.read.parquet(path)


@pytest.mark.parametrize("seed", [1, 2])
def test_may_hold_misses_no_folder_and_few_too_many(production, frame, seed, monkeypatch):
    """Against the true folders of each key; ranges overlap, so only the filters tell the folders apart."""
    rng = random.Random(seed)
    names = [f"{rng.randrange(10**9):09d}" for _ in range(4000)]
    warehouse = production([])
    for part in range(2):
        production([(n, 1 + i // 2 % 6) for i, n in enumerate(names) if i % 2 == part]).load("PRODUCTION")
    folders = warehouse.store.state(PRODUCTION)[1]
    assert len(folders) == 12 and all(f.level for f in folders)
    rows = warehouse.store.read_folders(PRODUCTION, folders).select("numerosuivi", F.input_file_name().alias("file")).collect()
    place = {r.numerosuivi: next(f.path for f in folders if f"{f.path}/" in r.file) for r in rows}
    assert len(place) == len(set(names))
    for chosen in ([rng.choice(names)], rng.sample(names, 3)):
        found = {f.path for f in warehouse.store.may_hold(PRODUCTION, folders, _wanted(warehouse, frame, chosen))}
        assert {place[c] for c in chosen} <= found
    held = sum(
        len(warehouse.store.may_hold(PRODUCTION, folders, _wanted(warehouse, frame, [f"{rng.randrange(10**9):09d}x"]))) for _ in range(12)
    )
    assert held <= 12  # of 144 questions
    monkeypatch.setattr(keyindex, "FIRST", 1)
    assert len(warehouse.store.may_hold(PRODUCTION, folders, _wanted(warehouse, frame, names))) == 12


def test_false_positives_change_nothing(production, monkeypatch):
    """With one bit for all keys every folder seems to hold every key."""
    monkeypatch.setattr(keyindex, "_bits", lambda hash: F.lit(1).cast("long"))
    monkeypatch.setattr(keyindex, "_word", lambda hash, level: F.lit(0).cast("long"))
    production([("a1", 1), ("a2", 2)]).load("PRODUCTION")
    assert production([("a1", 3), ("a3", 1), ("a3", 2)]).load("PRODUCTION").inserted == 1
    found = values(production([]).store.read(PRODUCTION).select("numerosuivi", "daterealisation"))
    assert [r[0] for r in found] == ["a1", "a2", "a3"] and found[0][1].month == 1


def test_an_insert_reads_only_folders_that_may_hold_a_key(production, reads):
    rng = random.Random(3)
    old = [f"k{rng.randrange(10**8)}" for _ in range(300)]
    warehouse = production([(n, 1 + i % 3) for i, n in enumerate(old)])
    assert warehouse.load("PRODUCTION").inserted == len(set(old))
    january = [f.path for f in warehouse.store.state(PRODUCTION)[1] if f.month == 2024 * 12 + 1]
    reads.clear()
    warehouse = production([(old[0], 5), ("k5new", 5)])
    assert warehouse.load("PRODUCTION").inserted == 1
    assert january[0] in reads and len(set(reads)) <= 3
    reads.clear()
    assert production([("z1", 1), ("z2", 1)]).load("PRODUCTION").inserted == 2
    newest = {f.path for f in warehouse.store.state(PRODUCTION)[1][-1:]}
    assert set(reads) == newest  # by range alone; the rows just written are checked


def test_an_append_asks_the_index_whether_a_key_is_taken(company, reads):
    company([(f"c{i}", "n", i) for i in range(1, 200)]).load("COMPANY")
    reads.clear()
    assert company([("c200x", "n", 500)]).load("COMPANY").inserted == 1
    assert reads == []
    with pytest.raises(LoadFailed, match="already in the table"):
        company([("c7", "n", 900)]).load("COMPANY")


def test_folders_without_an_index_are_read(production, spark):
    warehouse = production([("a", 1)])
    warehouse.load("PRODUCTION")
    version, folders = warehouse.store.state(PRODUCTION)
    from dataclasses import replace

    warehouse.store.commit(PRODUCTION, version, [replace(f, level=None, low=None, high=None, sums=None) for f in folders])
    assert production([("a", 2), ("b", 2)]).load("PRODUCTION").inserted == 1
    assert production([("a", 1), ("b", 2)]).sync("PRODUCTION").outcome == "in step"


def test_stored_fingerprints_add_up(company, spark):
    company([(f"c{i}", "n", i) for i in range(1, 50)]).load("COMPANY")
    warehouse = company([(f"c{i}", None, i) for i in range(50, 60)])
    warehouse.load("COMPANY")
    folders = warehouse.store.state(COMPANY)[1]
    assert len(folders) == 2
    row = warehouse.store.read(COMPANY).agg(*multiset_sums(COMPANY.schema.names)).first()
    assert added_up(folders) == tuple(row[n] for n in SUMS)
    assert [f.rows for f in folders] == [49, 10] and [f.cursor for f in folders] == [49, 59]


def test_a_sync_in_step_reads_nothing_stored(company, production, reads):
    rows = [(f"c{i}", "n", i) for i in range(1, 50)]
    company(rows).load("COMPANY")
    company(rows + [("d", "x", 90)]).load("COMPANY")
    production([("1", 1), ("2", 2)]).load("PRODUCTION")
    reads.clear()
    assert company(reversed(rows + [("d", "x", 90)])).sync("COMPANY").outcome == "in step"
    assert production([("2", 2), ("1", 1)]).sync("PRODUCTION").outcome == "in step"
    assert reads == []


def test_a_load_counts_while_it_writes(company, spark, tmp_path):
    """A load of new rows writes three times (keys apart) and reads no row just to count it."""
    written = company([(f"c{i}", "n", i) for i in range(1, 50)])
    report = written.load("COMPANY")
    assert report == LoadReport("COMPANY", "loaded", 49)
    with pytest.raises(LoadFailed, match="ROWID is null: 2 rows"):
        company([("x", "n", None), ("y", "n", None), ("z", "n", 99)]).load("COMPANY")


class TestBuckets:
    """Tables of 200 rows in 16 buckets."""

    @pytest.fixture(autouse=True)
    def _small(self, small_buckets):
        pass

    rows = [(f"c{i}", "n", i) for i in range(1, 201)]

    def _state(self, warehouse):
        return warehouse.store.state(COMPANY)[1]

    def _check(self, warehouse, rows):
        assert values(warehouse.store.read(COMPANY)) == sorted(rows, key=repr)
        ids = sorted(r.id for r in warehouse.store.read(COMPANY, with_id=True).collect())
        assert ids == list(range(1, len(rows) + 1))
        row = warehouse.store.read(COMPANY).agg(*multiset_sums(COMPANY.schema.names)).first()
        assert added_up(self._state(warehouse)) == tuple(row[n] or 0 for n in SUMS)

    def test_one_changed_row_rewrites_one_bucket(self, company):
        warehouse = company(self.rows)
        assert warehouse.load("COMPANY").inserted == 200
        self._check(warehouse, self.rows)
        before = {f.bucket: f.path for f in self._state(warehouse)}
        assert len(before) == 16
        changed = [("c7", "other", 7) if r[0] == "c7" else r for r in self.rows]
        assert company(changed).sync("COMPANY") == LoadReport("COMPANY", "loaded", 200)
        after = {f.bucket: f.path for f in self._state(warehouse)}
        assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
        self._check(warehouse, changed)

    def test_lost_and_new_rows(self, company):
        warehouse = company(self.rows)
        warehouse.load("COMPANY")
        before = {f.path for f in self._state(warehouse)}
        rows = [r for r in self.rows if r[0] not in ("c9", "c10")] + [("new", None, None)]
        company(rows).sync("COMPANY")
        assert 3 >= len(before - {f.path for f in self._state(warehouse)}) >= 1
        self._check(warehouse, rows)
        company(self.rows[:1]).sync("COMPANY")
        self._check(warehouse, self.rows[:1])
        company([]).sync("COMPANY")
        self._check(warehouse, [])
        company(self.rows).sync("COMPANY")
        self._check(warehouse, self.rows)

    def test_rows_appended_in_between_move_to_their_buckets(self, company):
        company(self.rows[:180]).load("COMPANY")
        warehouse = company(self.rows)
        assert warehouse.load("COMPANY").inserted == 20
        self._check(warehouse, self.rows)
        assert company(self.rows).sync("COMPANY").outcome == "in step"
        changed = [("c7", "other", 7) if r[0] == "c7" else r for r in self.rows]
        company(changed).sync("COMPANY")
        self._check(warehouse, changed)
        assert all(f.buckets == 16 for f in self._state(warehouse))
        more = changed + [("later", "n", 300)]
        assert company(more).load("COMPANY").inserted == 1
        self._check(warehouse, more)

    def test_a_table_that_outgrows_its_buckets_gets_more(self, company):
        company(self.rows[:30]).load("COMPANY")
        warehouse = company(self.rows)
        assert {f.buckets for f in self._state(warehouse)} == {2}
        warehouse.sync("COMPANY")
        assert {f.buckets for f in self._state(warehouse)} == {16}
        self._check(warehouse, self.rows)

    def test_a_repeated_key_is_found_in_its_bucket(self, company):
        warehouse = company(self.rows)
        warehouse.load("COMPANY")
        with pytest.raises(LoadFailed, match="CPY_0 is repeated"):
            company([*self.rows, ("c7", "twice", 700)]).sync("COMPANY")
        self._check(warehouse, self.rows)

    def test_differences_read_only_buckets_that_differ(self, company, reads):
        warehouse = company(self.rows)
        warehouse.load("COMPANY")
        assert warehouse.differences("COMPANY").count() == 0
        reads.clear()
        company([("c7", "other", 7), *[r for r in self.rows if r[0] not in ("c7", "c8")], ("c201", "n", 201)])
        found = values(warehouse.differences("COMPANY"))
        assert found == [("c201", "missing"), ("c7", "changed"), ("c8", "extra")]
        assert len(reads) <= 3
        with pytest.raises(ValueError):
            warehouse.differences("SALESINVOICE")

    def test_vacuum_of_buckets(self, company):
        warehouse = company(self.rows)
        warehouse.load("COMPANY")
        changed = [("c7", "other", 7) if r[0] == "c7" else r for r in self.rows]
        company(changed).sync("COMPANY")
        assert warehouse.vacuum("COMPANY", keep=1, hours=0) == 1
        self._check(warehouse, changed)
