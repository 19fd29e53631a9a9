"""Line dedup, mixing, classifier, decontamination: against SQL or brute force, and on awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, values
from tests.llm import plain
from tests.oracle import connect, differences
from tidemark.llm import decontaminate, lines, mixing, quality, queries


@pytest.fixture(scope="module")
def con():
    con = connect(SF_DIR)
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_as_sql(spark, con, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), con, queries.SQL[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


AWKWARD = [
    (1, "menu\n  menu \nown 1\n\n", "a"), (2, "menu\nown 2", "a"), (3, "menu\nown 3\nmenu", "a"), (3, "menu", "a"),
    (4, None, "a"), (5, "", "a"), (6, "menu\nx", None), (7, "menu\ny", None), (8, "menu\nz", None), (9, "menu", "b"),
    (None, "menu\nw", "a"),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_frequent_lines_on_awkward_rows(docs, request, broadcast):
    if not broadcast:
        request.getfixturevalue("forced_skew")
    given = [{"doc_id": i, "text": t, "source": s} for i, t, s in AWKWARD]
    df = docs(AWKWARD).withColumns({"kept": F.lit(1), "row": F.lit("r"), "bad": F.lit(2)})
    found = lines.drop_frequent_lines(df, ratio=0.4)
    assert found.columns == df.columns
    want = plain.without_frequent_lines(given, 0.4, 3)
    assert values(found.select("doc_id", "text", "source")) == sorted(
        ((d["doc_id"], t, d["source"]) for d, t in zip(given, want)), key=repr
    )
    assert lines.drop_frequent_lines(docs([])).count() == 0


def test_a_hot_site_is_spread(docs, forced_skew):
    given = [(i, f"top\nline {i}", "hot" if i % 3 else f"s{i}") for i in range(300)]
    found = {r["doc_id"]: r["text"] for r in lines.drop_frequent_lines(docs(given)).collect()}
    assert found == {i: f"line {i}" if i % 3 else t for i, t, _ in given}


def water_fill(sizes: dict, weights, epochs):
    """Targets by resharing the excess round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= epochs * sizes[s]}
        for s in full or free:
            target[s] = epochs * sizes[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        free -= full or free
    return target


def test_mix_on_awkward_rows(docs):
    rng = random.Random(4)
    given = [(i, "w " * rng.randrange(30), rng.choice(["a", "b", "c", None, "é", "z"])) for i in range(400)]
    given += [(None, "x y", "a"), (None, "x y", "a"), (7, None, "empty"), (8, " \t\n", "empty"), (9, "one\u00a0word", "a")]
    found = mixing.mix_sources(docs(given)).collect()
    assert len(found) == len(given)
    sizes = {}
    for _, t, s in given:
        sizes[s] = sizes.get(s, 0) + len(plain.WORD.findall(t or ""))
    target = water_fill(sizes, mixing.WEIGHTS, 2)
    for s, n in sizes.items():
        own = [r for r in found if r["source"] == s]
        assert {r["source_size"] for r in own} == {n} and own[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in own) - target[s]) < 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    assert values(mixing.mix_sources(docs(given[::-1]))) == sorted((tuple(r) for r in found), key=repr)
    assert mixing.mix_sources(docs([])).count() == 0


def test_mixed_documents_hold_the_mix(docs):
    given = [(i, "w " * (i % 9), "ab"[i % 2]) for i in range(200)]
    mix = {r["id"]: r["taken"] for r in mixing.mix_sources(docs(given)).collect()}
    out = mixing.mixed_documents(docs(given).withColumn("words", F.lit(0))).collect()
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["mix_taken"]
    assert got == {i: n for i, n in mix.items() if n}
    assert max(r["mix_epoch"] for r in out) <= 2


def test_scores_on_held_out_rows(spark, rows):
    found = {r["doc_id"]: r for r in queries.op8_zstd_quality(spark, SF_DIR).collect()}
    assert len(found) == len(rows("documents"))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    held = [(found[r["doc_id"]], r["quality"]) for r in rows("labels") if found[r["doc_id"]]["held_out"]]
    assert np.mean([r["predicted"] == y for r, y in held]) > 0.95
    bad, good = ([r["score"] for r, y in held if y == k] for k in (0, 1))
    assert np.mean([b < g for b in bad for g in good]) > 0.97


def test_scores_do_not_see_the_held_out_labels(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    hidden = labels.filter(quality.fold(F.col("doc_id")) != 1)
    assert quality.train(docs, labels) == quality.train(docs, hidden)


def test_scores_without_labels_or_texts(docs, frame):
    given = docs([(1, None, "a"), (2, "", "a"), (None, "some text", None), (2, "x" * 3_000_000, "a")])
    labels = frame("doc_id long, quality int", [])
    assert {r["score"] for r in quality.score_documents(given, labels).collect()} == {0.5}
    few = frame("doc_id long, quality int", [(1, 1), (2, 0), (2, 0), (None, 1), (5, None), (3, 1), (4, 0)])
    scores = quality.score_documents(given, few).collect()
    assert len(scores) == 4 and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.score_documents(docs([]), labels).count() == 0
    kept = quality.keep_good(given.withColumn("score", F.lit(9)), labels)
    assert kept.columns[-1] == "score" and kept.count() == 4


def test_leaks_equal_brute_force(spark, frame):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(rng.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [text(rng.randrange(6, 30)) for _ in range(8)] + ["ab", "", None, "Same item here is long enough"] * 2
    docs = []
    for k in range(40):
        item = list(items[rng.randrange(8)])
        for _ in range(rng.randrange(0, 14)):
            at = rng.randrange(len(item))
            item[at : at + rng.randrange(2)] = rng.choice(["x", "", "yz"])
        docs.append((k, f"{text(12)}  {''.join(item).upper()}\n{text(8)}"))
    docs += [(200, None), (201, ""), (None, items[0]), (203, items[3]), (203, items[3])]
    given, bench = frame("doc_id long, text string", docs), frame("item_id long, text string", list(enumerate(items)))
    found = decontaminate.leaks(given, bench).collect()
    index = decontaminate.Index([(i, decontaminate.normal(t or "")) for i, t in enumerate(items)])
    want = {}
    for i, t in docs:
        for k, item in index.items:
            if 0 < len(item) and i is not None:
                need = plain.edits(item, decontaminate.normal(t or "")) if len(item) >= decontaminate.Q else 0 if item in decontaminate.normal(t or "") else 99
                if need <= index.e[k]:
                    want[i, k] = need
    assert {(r["id"], r["item_id"]): r["edits"] for r in found if r["id"] is not None} == want
    assert any(want.values()) and 0 in [r["item_id"] for r in found if r["id"] is None]
    clean = decontaminate.drop_leaks(given.withColumn("row", F.lit(1)), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in docs if i is not None} - {i for i, _ in want}


@pytest.mark.parametrize("length, pieces, size", [(1_500, 75, 1), (5_000, 12, 20), (10_000, 12, 30), (3_000, 30, -5)])
def test_leaks_of_long_items_at_the_full_budget(length, pieces, size):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    item = text(length)
    bounds = [length * i // (pieces + 1) for i in range(pieces + 2)]
    cut = [item[i:j] for i, j in zip(bounds, bounds[1:])]
    edited = "".join([cut[0], *[text(max(size, 0)) + c[max(-size, 0) :] for c in cut[1:]]])
    index = decontaminate.Index([(1, item.encode()), (2, text(3_000).encode())])
    for before in (0, 17, 1_000):
        document = text(before) + edited + text(700)
        found = list(index.find(document.encode()))
        assert [k for k, *_ in found] == [1] and found[0][3] <= pieces * abs(size) <= index.e[0]


def test_leaks_do_not_depend_on_blocks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = values(decontaminate.leaks(docs, bench))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4_000)
    assert values(decontaminate.leaks(docs, bench)) == whole
    assert len(whole) - decontaminate.drop_leaks(docs, bench).count() + docs.count() >= len(whole)
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs.limit(0), bench).count() == 0
