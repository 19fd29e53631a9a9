"""Vector codes: against brute force in Python's integers, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import codes

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_force(rows, parts, entries, rounds):
    """{(id, label, code): ...} over (id, vector, label), all of one length."""
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * n : (p + 1) * n]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def code(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        found = [[code(v, p)[1] for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), x in zip(kept, found[p]) if x == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, l in kept:
        best = [code(v, p) for p in range(parts)]
        out.append((i, l, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    label = {l: sum(r[3] for r in out if r[1] == l) for _, _, l in kept}
    return sorted(((*r, label[r[1]], digest) for r in out), key=repr)


def found(df, **options):
    names = ["id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r[n] for n in names) for r in codes.compress(df, **options).collect()), key=repr)


@pytest.mark.parametrize("size", [1.0, 9e4])
def test_same_as_brute_force(frame, size):
    """The larger size needs several limbs."""
    rng = random.Random(int(size))
    rows = [(i, [rng.gauss(0, size) for _ in range(32)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(i, rows[i][1], 2) for i in range(40)] + [(None, rows[5][1], 1), (400, [0.0] * 32, 7), (401, [-0.001] * 32, 7)]
    assert found(frame(VECTORS, rows)) == brute_force(rows, 16, 64, 2)


def test_awkward_rows(frame):
    nan, inf = float("nan"), float("inf")
    good = [(3, [1.0, 2.0, 3.0, 4.0], None), (1, [-1.0, 0.5, 0.25, 8.0], 5), (1, [-1.0, 0.5, 0.25, 8.0], 5), (None, [0.0] * 4, None)]
    bad = [(0, None, 1), (2, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1), (5, [None, 0.0, 0.0, 0.0], 1), (6, [-inf] * 4, 1)]
    df = frame(VECTORS, good + bad).selectExpr("*", "1 AS id", "2 AS vector", "'x' AS error")
    assert found(df, parts=2) == brute_force(good, 2, 64, 2)
    assert found(frame(VECTORS, bad)) == [] == found(frame(VECTORS, []))


def test_vectors_that_cannot_be_coded_keep_their_row(frame):
    rows = [(1, [1.0] * 16, 1), (2, [2.0] * 16, 1), (3, [1.0] * 8, 1), (4, [], 1), (0, [1e30] * 16, 2)]
    got = {r[0]: r[2:5] for r in found(frame(VECTORS, rows))}
    assert got == {1: ("00" * 16, 0, 0), 2: ("01" * 16, 0, 0), 3: (None, None, 0), 4: (None, None, 0), 0: (None, None, None)}


def test_a_hot_label_is_spread(frame, forced_skew):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], 1 if i % 3 else i) for i in range(600)]
    assert found(frame(VECTORS, rows)) == brute_force(rows, 16, 64, 2)


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for bits in (8, 26, 29):
        x, y = rng.integers(-(1 << bits), 1 << bits, (50, 5)), rng.integers(-(1 << bits), 1 << bits, (20, 5))
        assert (codes.exact_products(x, y) == x @ y.T).all()
    x = np.array([[-(1 << 40), 3], [7, -1]])
    assert codes.exact_products(x, np.array([[1 << 20, -5]])).tolist() == [[-(1 << 60) - 15], [(7 << 20) + 5]]


def test_first_of_equal_distances():
    index, away = codes.nearest(np.array([[0, 0]]), np.array([[3, 0], [1, 0], [0, 1], [-1, 0]]))
    assert index.tolist() == [1] and away.tolist() == [1]
