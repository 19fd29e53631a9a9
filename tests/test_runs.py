"""Runs of days: against the same operators on days."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from tests.conftest import values
from tidemark.operators import loads, runs

GRID = "post string, plan string, what string, day date, hours double"
START = date(2024, 1, 1)


def _days(rng, posts, copies):
    rows = []
    for p in posts:
        for plan in ("w", None):
            at = START + timedelta(days=rng.randrange(10))
            for _ in range(rng.randrange(1, 4)):
                hours, n, step = rng.choice([1.0, 2.0, None]), rng.randrange(1, 9), rng.choice([1, 7, 7])
                what = rng.choice(["a", "b"])
                rows += [(p, plan, what, at + timedelta(days=step * i), hours) for i in range(n)] * rng.choice(copies)
                at += timedelta(days=7 * rng.randrange(0, 6))
    return rows + [(posts[0], "w", "a", None, 1.0), (None, "w", "a", START, 3.0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_hold_the_same_rows(frame, seed):
    rows = _days(random.Random(seed), ["p", "q", None], [1, 1, 2])
    df = frame(GRID, rows)
    found = runs.to_runs(df, "day", 7)
    dated = [r for r in rows if r[3] is not None]
    assert values(runs.to_days(found, "day", 7, df.columns)) == sorted(dated, key=repr)
    assert found.count() < len(dated)


def test_a_regular_grid_is_one_run_a_weekday(frame):
    rows = [("p", "w", "a", START + timedelta(days=i), 1.0) for i in range(700)]
    assert runs.to_runs(frame(GRID, rows), "day", 7).count() == 7
    assert runs.to_runs(frame(GRID, rows), "day", 1).count() == 1
    hole = [r for r in rows if r[3] != START + timedelta(days=70)] + [rows[3]]
    assert runs.to_runs(frame(GRID, hole), "day", 7).count() == 9
    assert runs.to_runs(frame(GRID, []), "day", 7).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_upsert_of_runs_is_the_upsert_of_days(frame, seed):
    rng = random.Random(10 + seed)
    src, tgt = _days(rng, ["p", "q", "r", None], [1]), _days(rng, ["p", "q", "s", None], [1, 2])
    keys, update = ["post", "plan", "day"], ["what", "hours"]
    source, target = frame(GRID, src).distinct(), frame(GRID, tgt)
    want = values(loads.upsert(source, target, keys, update))
    assert values(runs.upsert_days(source, target, keys, update, "day", 7)) == want


def test_cut_runs_have_all_days_or_none_in_common(frame):
    rng = random.Random(5)
    sides = [runs.to_runs(frame(GRID, _days(rng, ["p", "q"], [1])), "day", 7) for _ in range(2)]
    for cut, side in zip(runs.cut_alike(sides, ["post", "plan"], 7), sides):
        columns = ["post", "plan", "what", "day", "hours"]
        assert values(runs.to_days(cut, "day", 7, columns)) == values(runs.to_days(side, "day", 7, columns))
    both = [tuple(r) for cut in runs.cut_alike(sides, ["post", "plan"], 7) for r in cut.select("post", "plan", runs.FIRST, runs.LAST).collect()]
    for a in both:
        for b in both:
            if a[:2] == b[:2] and (a[2] - b[2]).days % 7 == 0:
                assert a[2:] == b[2:] or a[3] < b[2] or b[3] < a[2]


@pytest.mark.parametrize("seed", range(3))
def test_touched_months_of_runs_are_those_of_days(frame, seed):
    rng = random.Random(20 + seed)
    sides = [[r for r in _days(rng, ["p", "q", s, None], [1, 2]) if r[3]] for s in "rs"]
    source, target = frame(GRID, sides[0]).distinct(), frame(GRID, sides[1] + sides[0][:20])
    want = loads.touched_months(source, target, ["post", "plan", "day"], "day").select("month", "matched")
    found = runs.touched_months(*[runs.to_runs(df, "day", 7) for df in (source, target)], ["post", "plan"], 7)
    kept = lambda df: {r.month: r.matched for r in df.collect() if r.month is not None or r.matched}
    assert kept(found).keys() == kept(want).keys()
    assert sum(kept(found).values()) == sum(kept(want).values())


@pytest.mark.parametrize("period", [1, 7, 45])
def test_runs_cut_by_month_hold_the_same_days(frame, period):
    rows = [("p", "w", "a", START + timedelta(days=3 + period * i), 1.0) for i in range(40)]
    found = runs.to_runs(frame(GRID, rows), "day", period)
    cut = runs.by_month(found, period)
    assert values(runs.to_days(cut, "day", period, ["post", "plan", "what", "day", "hours"])) == sorted(rows, key=repr)
    assert all((r[runs.FIRST].year, r[runs.FIRST].month) == (r[runs.LAST].year, r[runs.LAST].month) for r in cut.collect())


def test_the_store_shuffles_and_sorts_runs(spark, tmp_path, frame, monkeypatch):
    """Days are made in the tasks that write; nothing is sorted to find a least key where there is none."""
    from tidemark.plans.shopfloor import CAPACITY
    from tidemark.sources import store

    sorted_frames = []
    monkeypatch.setattr(store, "sort_for_layout", lambda df, by: sorted_frames.append(df) or df.sortWithinPartitions(*by))
    names = CAPACITY.schema.names
    rows = [("p", "w", "a", "c", START + timedelta(days=7 * i), 1.0) for i in range(20)]
    grid = frame("poste string, schema string, designationPoste string, company string, dateschema date, tempstheorique double", rows)
    house = store.Store(spark, str(tmp_path))
    written = house.write(CAPACITY, runs.to_runs(grid, "dateschema", 7))
    assert written.rows == 20 and sorted_frames[0].count() == 5 == len(written.folders)
    assert values(house.read_folders(CAPACITY, written.folders).select(*names)) == sorted(rows, key=repr)
    facts = grid.groupBy("poste").agg(*house._facts(CAPACITY, {}))
    assert "SortAggregate" not in facts._jdf.queryExecution().executedPlan().toString()
