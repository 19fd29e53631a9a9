"""The load protocols against a plain model: lists of rows and loops."""

from __future__ import annotations

import random

import pytest

from tests.conftest import values
from tidemark.operators import loads, rows

SCHEMA = "k string, o int, v string"


def _tables(seed):
    r = random.Random(seed)

    def row():
        return (r.choice(["a", "b", "c", "d", "e"]), r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"]))

    source = [row() for _ in range(r.randint(0, 12))]
    held = {}
    for k, o, v in (row() for _ in range(r.randint(0, 6))):
        held[k] = (k, o, v)
    return source, list(held.values())


def _sorted(source):
    """In the declared order, nulls first, ties by content."""
    return sorted(source, key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or ""))


def _ordered(result):
    return sorted(result, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_insert_absent(frame, seed):
    source, held = _tables(seed)
    have, added = {k for k, _, _ in held}, []
    for row in _sorted(source):
        if row[0] not in have:
            have.add(row[0])
            added.append(row)
    got = loads.insert_absent(frame(SCHEMA, source), frame(SCHEMA, held), ["k"], ["o"])
    assert values(got) == _ordered(added)


@pytest.mark.parametrize("seed", range(6))
def test_merge_and_its_counts(frame, seed):
    source, held = _tables(seed)
    state, inserted, updated = {r[0]: r for r in held}, 0, 0
    for row in _sorted(source):
        inserted, updated = (inserted, updated + 1) if row[0] in state else (inserted + 1, updated)
        state[row[0]] = row
    src, tgt = frame(SCHEMA, source), frame(SCHEMA, held)
    assert values(loads.merge(src, tgt, ["k"], ["o"])) == _ordered(state.values())
    assert tuple(loads.merge_counts(src, tgt, ["k"]).first()) == (inserted, updated)


@pytest.mark.parametrize("seed", range(6))
def test_upsert(frame, seed):
    """Composite key with nulls, duplicate keys on both sides."""
    r = random.Random(seed)

    def some(n):
        return [(r.choice("abc"), r.choice([None, 1, 2]), r.choice([None, "x", "y"])) for _ in range(n)]

    source, held = some(8), some(5)
    unique = list(dict.fromkeys(source))
    best = {}
    for row in sorted(unique, key=lambda t: (t[2] is not None, t[2] or "")):
        best[row[:2]] = row
    expected = [best.get(row[:2], row) if None not in row[:2] else row for row in held]
    known = {row[:2] for row in held if None not in row[:2]}
    expected += [row for row in unique if row[:2] not in known]
    src, tgt = frame(SCHEMA, source), frame(SCHEMA, held)
    assert values(loads.upsert(src, tgt, ["k", "o"], ["v"])) == _ordered(expected)


@pytest.mark.parametrize("seed", range(6))
def test_upsert_of_unique_keys_gives_the_same(frame, seed):
    source, held = _tables(seed)
    one = rows.collapse(frame(SCHEMA, source), ["k"], ["o"], "last")
    tgt = frame(SCHEMA, held + [(None, 1, "x"), ("a", 7, "again")])
    general = loads.upsert(one, tgt, ["k"], ["o", "v"])
    assert values(loads.upsert(one, tgt, ["k"], ["o", "v"], unique_source=True)) == values(general)


def test_append_is_strict_and_keeps_rows_without_cursor(frame):
    src = frame("c long, v string", [(-1, "a"), (0, "b"), (1, "c"), (None, "d")])
    assert values(loads.append_above(src, 0, "c")) == [(1, "c"), (None, "d")]


def test_append_filter_reaches_the_scan(sources):
    plan = loads.append_above(sources("SALESREP"), 50, "ROWID")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "PushedFilters: [" in plan
    assert "50" in plan.split("DataFilters: [")[1].split("]")[0]


DATED = "k string, d date, v string"


def _touched(frame, source, held):
    from datetime import date

    def rows_of(given):
        return [(k, date(2020, m, 1) if m else None, v) for k, m, v in given]

    found = loads.touched_months(frame(DATED, rows_of(source)), frame(DATED, rows_of(held)), ["k"], "d").collect()
    months = sorted(r.month - 2020 * 12 if r.month else r.month for r in found if r.month is not None)
    return months, sum(r.matched for r in found)


def test_touched_months(frame):
    assert _touched(frame, [("a", 1, "x")], [("a", 1, "x"), ("z", 5, "y")]) == ([], 1)
    assert _touched(frame, [("a", 2, "x")], [("a", 1, "x")]) == ([1, 2], 1)
    assert _touched(frame, [("a", 3, "y")], [("a", 3, "x")]) == ([3], 1)
    assert _touched(frame, [("n", 4, "x")], []) == ([4], 0)
    assert _touched(frame, [("a", 1, "x"), ("a", 4, "x")], [("a", 2, "x")]) == ([1, 2, 4], 1)
    assert _touched(frame, [(None, 6, "x")], [(None, 6, "x")]) == ([6], 0)
    assert _touched(frame, [("a", None, "x")], [("a", 3, "x")])[0] == [0, 3]
    assert _touched(frame, [], [("a", 3, "x")]) == ([], 0)


@pytest.mark.parametrize("seed", range(4))
def test_merge_of_touched_months_equals_merge_of_all(frame, seed):
    from datetime import date

    from tidemark.functions.scalars import month_number

    r = random.Random(seed)

    def some(n):
        return [(r.choice("abcdef"), date(2020, r.randint(1, 6), 1), r.choice("xy")) for _ in range(n)]

    held = list({row[0]: row for row in some(6)}.values())
    src, tgt = frame(DATED, some(5)), frame(DATED, held)
    months = [m.month for m in loads.touched_months(src, tgt, ["k"], "d").collect() if m.month is not None]
    inside = month_number("d").isin(months)
    part = loads.merge(src.filter(inside), tgt.filter(inside), ["k"], ["d"])
    assert values(part.unionByName(tgt.filter(~inside))) == values(loads.merge(src, tgt, ["k"], ["d"]))


def test_insert_reads_the_source_once(sources):
    production = sources("MFGITMTRK")
    plan = loads.insert_absent(production, production, ["MFGTRKNUM_0"], ["IPTDAT_0"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_a_missing_day_touches_no_month_between(frame):
    assert _touched(frame, [("a", None, "x"), ("a", 12, "y"), ("a", 2, "z")], [("a", 12, "x")])[0] == [0, 2, 12]
