"""Elias-Fano sequences and the n-gram trie: against plain Python, and on awkward rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.plain import LOWER, WORD
from tidemark.llm import ngrams
from tidemark.llm.eliasfano import Monotone, load, prefixed, save, sequence

FIXED = (0.7, 0.9, 1.1)


def words(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def learns(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 != 0


def brute_force(rows):
    """(id, held out, tokens, known, total, base score, score) with dicts of n-gram counts and the discounts FIXED."""
    train = [words(t) for i, t in rows if learns(i)]
    one = Counter(w for t in train for w in t)
    total, kinds = sum(one.values()), len(one)
    two, three = defaultdict(Counter), defaultdict(Counter)
    for t in train:
        full = ["<s>", "<s>", *t]
        for a, b, c in zip(full, full[1:], full[2:]):
            two[b][c] += 1
            three[a, b][c] += 1
    base = lambda w: (one[w] + 0.1) / (total + 0.1 * (kinds + 1))
    off = lambda n: FIXED[min(n, 3) - 1]

    def smooth(follow, w, lower):
        if not follow:
            return lower
        left = sum(off(n) for n in follow.values()) / sum(follow.values())
        return max(follow[w] - off(follow[w]), 0) / sum(follow.values()) + left * lower if follow[w] else left * lower

    out = []
    for i, text in rows:
        own = words(text)
        full = ["<s>", "<s>", *own]
        grams = list(zip(full, full[1:], own))
        score = sum(math.log10(smooth(three.get((a, b)), c, smooth(two.get(b), c, base(c)))) for a, b, c in grams)
        out.append((i, not learns(i), len(own), sum(one[w] > 0 for w in own), total, sum(math.log10(base(w)) for w in own), score))
    return out


def some(n, seed=1, kinds=60, longest=60):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(kinds)]
    rows = []
    for i in range(n):
        text, at = [], rng.randrange(kinds)
        for _ in range(rng.randrange(longest)):
            text.append(names[at].upper() if rng.random() < 0.1 else names[at])
            at = (at * 7 + rng.choice([1, 1, 1, 2, 30])) % kinds if rng.random() < 0.8 else 0
        rows.append((i, rng.choice([" ", "\n\t"]).join(text) + rng.choice(["", f" own{i}"])))
    return rows


def check(found, rows, steps=True):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want = sorted(brute_force(rows), key=key)
    got = sorted((tuple(r) for r in found.collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-6)
        assert abs(g[6] - w[6]) <= w[2] * 6e-4 + 1e-6  # two rounded codes a token


def _fine(name, probability):
    """Probabilities in so many steps that only the trie's own arithmetic is compared."""
    codes = np.round(-np.log10(probability) * 2048).astype(np.uint16)
    return {f"{name}.codes": codes, f"{name}.means": np.arange(1 << 16) / 2048}


@pytest.fixture
def fixed(monkeypatch):
    monkeypatch.setattr(ngrams, "_discounts", lambda n: np.array(FIXED))
    monkeypatch.setattr(ngrams, "_quantised", _fine)


@pytest.mark.parametrize("shard", [1 << 21, 200, 40])
def test_same_as_brute_force(frame, fixed, shard):
    """The smaller shards split frequent words into many parts."""
    rows = some(250) + [(300, None), (301, ""), (302, " \n "), (None, "w1 w2"), (5, "w1 w2 w3"), (303, "nobody knows THESE words")]
    df = frame("doc_id long, text string", rows).selectExpr("*", "1 AS id", "2 AS hash", "3 AS piece")
    check(ngrams.score_documents(df, shard=shard), rows)


def test_many_pieces_and_files(frame, fixed, monkeypatch):
    monkeypatch.setattr(ngrams, "PIECES", 3)
    monkeypatch.setattr(ngrams, "VOCABULARY", 16)
    monkeypatch.setattr("tidemark.llm.frames.BATCH_BYTES", 400)
    rows = some(200, seed=2)
    check(ngrams.score_documents(frame("doc_id long, text string", rows).repartition(4), shard=500), rows)


def test_one_word_over_and_over(frame, fixed):
    rows = [(i, "la " * 300) for i in range(30)] + [(40, "la la land"), (41, "la " * 200_000)] + some(30, seed=3)
    check(ngrams.score_documents(frame("doc_id long, text string", rows), shard=1000), rows)


def test_nothing_to_learn_from(frame):
    assert ngrams.score_documents(frame("doc_id long, text string", [])).count() == 0
    held = [i for i in range(200) if not learns(i)]
    rows = [tuple(r) for r in ngrams.score_documents(frame("doc_id long, text string", [(i, "a b") for i in held])).collect()]
    assert sorted(rows) == [(i, True, 3, 0, 0, 0.0, 0.0) for i in held]


def test_probabilities_add_up(frame):
    """After any two tokens the probabilities of all tokens, an unknown one included, add up to 1."""
    rows = some(300, seed=4, kinds=12)
    model = ngrams.train(frame("doc_id long, text string", rows).filter("length(text) > 0"), shard=700)
    v = model.vocabulary
    for a in (*range(0, 10, 3), v.start, v.unknown):
        for b in (*range(0, 10, 2), v.start):
            every = np.arange(v.unknown + 1)
            w1, w2 = np.full(len(every), a), np.full(len(every), b)
            splits = model.splits(v.counts(w2[:1]))
            shard = model.shard_of(w2[:1], model.part_of(w1[:1], splits) if splits[0] > 1 else w2[:1] * 0)
            found = ngrams.Shard(model.path(int(shard[0])), v).scores(w2, w1, every)
            assert (10**found).sum() == pytest.approx(1, abs=3e-2)


def test_quantised_to_a_byte():
    p = np.random.default_rng(1).uniform(1e-6, 1, 5000)
    own = ngrams._quantised("x", p)
    near = own["x.means"][own["x.codes"]]
    assert own["x.codes"].dtype == np.uint8
    assert np.abs(near + np.log10(p)).max() < 6 / 255 and near.sum() == pytest.approx(-np.log10(p).sum())
    assert ngrams._quantised("x", np.array([0.25, 0.25]))["x.means"][0] == pytest.approx(-math.log10(0.25))
    assert len(ngrams._quantised("x", p[:0])["x.codes"]) == 0


def test_scores_of_bytes_stay_near(frame, monkeypatch):
    monkeypatch.setattr(ngrams, "_discounts", lambda n: np.array(FIXED))
    rows = some(300, seed=6)
    want = {r[0]: r for r in brute_force(rows)}
    for r in ngrams.score_documents(frame("doc_id long, text string", rows)).collect():
        assert abs(r["score"] - want[r["id"]][6]) <= 0.02 * r["n_tokens"]


def test_held_out_texts_score_better_than_by_the_base_model(spark, frame):
    rows = some(2000, seed=5)
    found = ngrams.score_documents(frame("doc_id long, text string", rows)).filter("held_out")
    total = found.selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert total["s"] > 0.8 * total["b"]


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 1 << 64), (900, 1000), (1000, 10**6), (50_000, 1 << 64), (300, 1 << 40)])
def test_elias_fano(tmp_path, n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
    path = f"{tmp_path}/deep/file"
    save(path, prefixed("x", Monotone.of(values)) | {"empty": np.zeros(0, dtype=np.uint16)})
    save(path, prefixed("x", Monotone.of(values)))
    near = np.concatenate([values, values + np.uint64(1), values - np.uint64(1), rng.integers(0, top, 50, dtype=np.uint64)])
    for own in (sequence(load(path), "x"), sequence(load(path), "x").prepared()):
        assert (own[np.arange(len(values))] == values).all()
        place, equal = own.successor(near)
        assert (place == np.searchsorted(values, near)).all() and (equal == np.isin(near, values)).all()
    assert load(f"{tmp_path}/none") is None


def test_elias_fano_with_repeats_takes_few_bits():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 100_000))
    own = Monotone.of(np.concatenate([values, values[-1:]]))
    assert (own[np.arange(100_001)] == np.concatenate([values, values[-1:]])).all()
    assert sum(a.nbytes for a in own.arrays().values()) * 8 / len(values) < 2 + math.log2((1 << 30) / 100_000) + 2


def test_packed_arrays():
    a, b = np.array([1, 70000, 3]), np.array([0.5, -1.0, 2.0])
    for got, want in zip(ngrams.unpack(ngrams.pack(a, b)), (a, b)):
        assert got.tolist() == want.tolist()
    assert [x.tolist() for x in ngrams.unpack(ngrams.pack(a[:0]))] == [[]]


def test_wide_columns_have_a_sort_key():
    """Ranks stand for numbers whose bits do not fit together, as ids of a large vocabulary."""
    rng = np.random.default_rng(7)
    columns = [rng.choice(rng.integers(0, 1 << 40, 50), 3000) for _ in range(3)]
    assert ngrams.sort_key(columns) is not None
    order = ngrams.sorted_order(columns)
    assert [tuple(r) for r in np.stack(columns)[:, order].T] == sorted(zip(*columns))
    assert ngrams.sort_key([rng.permutation(1 << 17) << 40 for _ in range(4)]) is None


def test_each_ngram_is_looked_up_once(frame, monkeypatch):
    rows = some(200, seed=8, kinds=12)
    model = ngrams.train(frame("doc_id long, text string", rows))
    v, rng, asked = model.vocabulary, np.random.default_rng(8), []
    w2, w1, w3 = rng.integers(0, v.start + 1, (3, 5000)) % 9
    shard, own = ngrams.Shard(model.path(0), v), ngrams.Shard._scores
    alone = [shard.scores(*(c[i : i + 1] for c in (w2, w1, w3)))[0] for i in range(300)]
    monkeypatch.setattr(ngrams.Shard, "_scores", lambda self, *c: asked.extend(zip(*c)) or own(self, *c))
    found = shard.scores(w2, w1, w3)
    assert found[:300].tolist() == alone
    assert sorted(asked) == sorted(set(zip(w2, w1, w3)))


def test_split_words_are_those_that_occur_often(frame):
    model = ngrams.train(frame("doc_id long, text string", some(300, seed=9, kinds=20)), shard=400)
    v = model.vocabulary
    every = np.array([*range(v.unknown), v.start])
    split = every[model.splits(v.counts(every)) > 1]
    assert 0 < len(split) < len(every) and model.split_words.tolist() == split.tolist()


def test_elias_fano_numbers_and_unordered_targets(monkeypatch):
    monkeypatch.setattr("tidemark.llm.eliasfano.TOGETHER", 100)
    for top in (1000, 1 << 50):
        values = np.sort(np.random.default_rng(2).integers(0, top, 777)).astype(np.uint64)
        own = Monotone.of(values)
        assert (own.numbers() == values).all()
        targets = np.random.default_rng(3).permutation(np.concatenate([values, values, values + np.uint64(1)]))
        for asked in (own, own.prepared()):
            place, equal = asked.successor(targets)
            assert (values[place[equal]] == targets[equal]).all() and (equal == np.isin(targets, values)).all()
    assert len(Monotone.of(values[:0]).numbers()) == 0
