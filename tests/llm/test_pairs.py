"""SimHash, parity-sketch join, chunks: against brute force, and on awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, values
from tests.llm import plain
from tidemark.llm import chunks, graph, parity, queries, simhash, words


def test_edited_texts_and_next_documents(spark, rows):
    import hashlib

    found = {r["doc_id"]: r for r in queries.op1_simhash(spark, SF_DIR).collect()}
    docs = sorted(rows("documents"), key=lambda d: d["doc_id"])
    assert len(found) == len(docs)
    for d, after in zip(docs, docs[1:] + docs[:1]):
        text, quarter = d["text"], len(d["text"]) // 4
        edited = text[: len(text) - quarter] + after["text"][:quarter]
        r, n = found[d["doc_id"]], found[after["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        differ = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
        assert r["near_edited"] == 1 - differ(r["fingerprint"], r["edited_fingerprint"]) / 64
        assert r["near_next"] == 1 - differ(r["fingerprint"], n["fingerprint"]) / 64
    apart = [r["near_edited"] > r["near_next"] for r in found.values()]
    assert np.mean(apart) > 0.98


def test_fingerprint_is_the_vote_of_weighted_terms(spark, frame):
    text = "The cat sat on the mat, the  CAT\tsat"
    df = frame("k long, text string", [(1, text), (2, None), (3, "")])
    terms = sorted(set(text.lower().split()))
    hashes = frame("w string", [(t,) for t in terms]).select("w", F.xxhash64("w").alias("h")).collect()
    votes = [sum(len(r["w"]) * (1 if r["h"] >> b & 1 else -1) for r in hashes) for b in range(64)]
    want = sum(1 << b for b in range(64) if votes[b] > 0)
    got = dict(simhash.fingerprints(df, ["k"], "text").collect())
    assert got[1] % (1 << 64) == want
    assert got[2] == got[3] == 0


def test_edited_awkward_rows(docs):
    given = [(1, None, "a"), (2, "", "a"), (2, "same id", "a"), (None, "no id at all", "b"), (5, "x" * 9, None), (5, "x" * 9, None)]
    found = simhash.compare_edited(docs(given)).collect()
    assert sorted((r["id"] is None, r["id"] or 0, r["n_chars"]) for r in found) == sorted(
        (i is None, i or 0, len(t or "")) for i, t, _ in given
    )
    assert [r["near_next"] for r in found if r["id"] is None] == [None]
    assert {r["near_next"] for r in found if r["id"] == 5} >= {1.0}
    assert simhash.compare_edited(docs([])).count() == 0
    assert simhash.compare_edited(docs([(None, "a b", "c")])).count() == 1


def test_block_tables_find_all_within_the_radius(frame):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (0, 1, 2, 3, 3, 4, 5)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints, asked = frame("fp long", [(signed(x),) for x in near] + [(None,)]), frame("fp long", [(signed(x),) for x in base])
    want = {(signed(q), signed(x), (q ^ x).bit_count()) for q in base for x in near if (q ^ x).bit_count() <= 3}
    found = values(simhash.within_radius(asked, prints))
    assert set(found) == want and len(found) == len(want)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_equal_brute_force(spark, rows, docs, size, percent):
    rng = random.Random(size)
    texts = [d["text"] for d in rows("documents")[:150]]
    for t in list(texts[:40]):  # chains of ever more edited copies
        for _ in range(4):
            w = t.split(" ")
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(["red", "", "blue green"])
            t = " ".join(w)
            texts.append(t)
    texts += [None, "", " \t\n", "one", "ONE", "one two", "two one", "a b c", "a  b\tc", "a b c d"]
    found = {r["id"]: r for r in parity.document_components(docs([(i, t, "s") for i, t in enumerate(texts)]), words=size, percent=percent).collect()}
    want = plain.groups(texts, size, percent)
    assert [found[i]["component_id"] for i in range(len(texts))] == want
    assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(plain.shingles(t, size)) for t in texts]


def test_part_keys_always_meet():
    """Any two sets that differ in no more than allowed share a key, also tiny sets with empty parts."""
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        bands = parity.Bands(percent)
        for n in [4, 5, 9, 10, 11, 13, 17, 18, 30, 60, 200] * 8:
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            d = parity.max_difference(n, percent)
            b = np.concatenate([a[rng.integers(0, d + 1) :], rng.integers(0, 1 << 63, d, dtype=np.uint64)])
            shared = len(np.intersect1d(a, b))
            if 100 * shared < percent * (len(a) + len(b) - shared):
                continue
            keys = [{k for _, _, own in parity.part_keys(x, bands) for k in own.tolist()} for x in (a, b)]
            assert keys[0] & keys[1] or set(a) == set(b)
            sketches = [parity.parity_sketch(x) for x in (a, b)]
            assert np.bitwise_count(sketches[0] ^ sketches[1]).sum() <= len(a) + len(b) - 2 * shared


@pytest.mark.parametrize("block", [1000, 7])
def test_components_with_a_passage_in_a_third_of_all_texts(docs, monkeypatch, block):
    """Unlike texts around one passage, near copies of some of them, and templates that are alike but not enough."""
    monkeypatch.setattr(parity, "BLOCK", block)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(5000)}"
    passage, template = ([word() for _ in range(n)] for n in (60, 40))
    texts = []
    for i in range(300):
        own = [word() for _ in range(rng.choice([10, 40, 150]))]
        at = rng.randrange(len(own))
        texts.append(own[:at] + (passage if i % 3 == 0 else template if i % 3 == 1 else []) + own[at:])
    for t in texts[:90]:
        for _ in range(rng.randrange(3)):
            t = list(t)
            t[rng.randrange(len(t))] = word()
            texts.append(t)
    texts = [" ".join(t) for t in texts]
    for size, percent in ((5, 80), (3, 90)):
        rows = parity.document_components(docs([(i, t, "s") for i, t in enumerate(texts)]), words=size, percent=percent)
        found = {r["id"]: r["component_id"] for r in rows.collect()}
        assert [found[i] for i in range(len(texts))] == plain.groups(texts, size, percent)


def test_linked_sets_share_one_of_their_rarest_keys(spark):
    """Pairs of linked sets among many that share frequent keys; keys of one set only are left out, as in the join."""
    rng = np.random.default_rng(6)
    common = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    for percent in (80, 90):
        bands, sets, pairs = parity.Bands(percent), [], []
        for n in [5, 9, 12, 30, 60, 200] * 6:
            a = np.concatenate([common[: n // 2], rng.integers(0, 1 << 63, n - n // 2, dtype=np.uint64)])
            b = np.concatenate([a[: n - parity.max_difference(n, percent) // 2], rng.integers(0, 1 << 63, 1, dtype=np.uint64)])
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                pairs.append((len(sets), len(sets) + 1))
            sets += [np.unique(a), np.unique(b)]
        keys, empty = [], []
        for sid, x in enumerate(sets):
            found = parity.part_keys(x, bands)
            keys += [(sid, k) for _, _, own in found for k in own.view(np.int64).tolist()]
            empty.append((sid, [(gaps << parity.BAND_BITS) + band for band, gaps, _ in found]))
        members = spark.createDataFrame(keys, "sid long, key long").dropDuplicates()
        counts = members.groupBy("key").count().withColumnRenamed("count", "c").filter("c > 1")
        kept = parity.rarest_keys(members.join(counts, "key"), spark.createDataFrame(empty, "sid long, empty array<long>"), percent)
        own = {sid: set() for sid in range(len(sets))}
        for r in kept.collect():
            own[r["sid"]].add(r["key"])
        assert len(pairs) > 20 and all(own[a] & own[b] for a, b in pairs)
        assert sum(map(len, own.values())) < members.join(counts, "key").count()


def test_copies_edited_too_much_are_ruled_out_by_their_sketches(spark):
    """Pairs of a group of copies, each edited a little more than a link allows, are not made; linked pairs all are."""
    rng = np.random.default_rng(8)
    fresh = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for percent, edits in ((80, 43), (90, 20)):
        base = fresh(400)
        copies = [np.concatenate([base[np.sort(rng.permutation(400)[edits:])], fresh(edits)]) for _ in range(40)]
        near = [np.concatenate([base[: 400 - k], fresh(k)]) for k in (1, 5, 10, 15)]
        sets = [(len(x), *parity.parity_sketch(x).view(np.int64).tolist()) for x in [base, *near, *copies]]
        columns = ["n", *[f"s{j}" for j in range(parity.SKETCH)]]
        rows = spark.createDataFrame([(i, *s) for i, s in enumerate(sets)], "sid long, " + ", ".join(f"{c} long" for c in columns))
        pairs = parity._side(rows, "x").crossJoin(parity._side(rows, "y")).filter("x_sid < y_sid").filter(parity._could_link(percent))
        found = {(r["x_sid"], r["y_sid"]) for r in pairs.select("x_sid", "y_sid").collect()}
        assert found >= {(0, i) for i in range(1, 5)}
        assert sum(a > 4 for a, _ in found) <= 40 * 39 // 2 // 20


def test_smaller_sets_of_a_band_need_fewer_keys(spark):
    """With sizes given, linked sets at the low end of a band still share a key, and fewer keys are kept."""
    rng = np.random.default_rng(7)
    bands, sets, pairs = parity.Bands(80), [], []
    low = next(bands.low(b) for b in range(30) if bands.low(b) > 200)
    for _ in range(30):
        a = rng.integers(0, 1 << 63, low + 5, dtype=np.uint64)
        b = np.concatenate([a[: low + 5 - parity.max_difference(low, 80) // 2], rng.integers(0, 1 << 63, 20, dtype=np.uint64)])
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            pairs.append((len(sets), len(sets) + 1))
        sets += [a, b]
    keys, sizes = [], []
    for sid, x in enumerate(sets):
        found = parity.part_keys(x, bands)
        keys += [(sid, k) for _, _, own in found for k in own.view(np.int64).tolist()]
        sizes.append((sid, [(gaps << parity.BAND_BITS) + band for band, gaps, _ in found], len(x)))
    members = spark.createDataFrame(keys, "sid long, key long").dropDuplicates().withColumn("c", F.lit(2).cast("long"))
    known = spark.createDataFrame(sizes, "sid long, empty array<long>, n long")
    own = {sid: set() for sid in range(len(sets))}
    for r in parity.rarest_keys(members, known, 80).collect():
        own[r["sid"]].add(r["key"])
    assert len(pairs) > 20 and all(own[a] & own[b] for a, b in pairs)
    assert sum(map(len, own.values())) < parity.rarest_keys(members, known.drop("n"), 80).count()


def test_one_per_group_awkward_rows(docs, frame):
    text = "one two three four five six seven eight"
    given = [(3, text, "a"), (None, text, "a"), (3, text, "a"), (7, text.upper(), "b"), (9, None, "c"), (10, "", "c"), (None, None, "c")]
    kept = parity.one_per_group(docs(given).withColumn("component", F.lit(1)).withColumn("row", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "component", "row"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (3, text), (9, ""), (10, "")]
    nameless = docs([(None, text, "a"), (None, text, "a"), (None, text + " nine ten", "b")])
    assert parity.one_per_group(nameless).count() == 2
    assert parity.one_per_group(docs([])).count() == 0


def test_components_of_a_graph(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 199)]
    labels = dict(values(graph.components(frame("a long, b long", links))))
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 199: 199, 200: 199}


def test_word_hashes_do_not_depend_on_place():
    texts = ["alpha Beta", "  beta\tALPHA ", "", None, "é beta"]
    sets = words.shingle_sets(pa.array(texts), 1)
    assert set(sets[0]) == set(sets[1]) and len(sets[2]) == len(sets[3]) == 0
    assert len(set(sets[4]) & set(sets[0])) == 1


def test_repeated_passages_equal_brute_force(spark, rows):
    found = queries.op7_gear_chunks(spark, SF_DIR).collect()
    texts = {d["doc_id"]: d["text"] for d in rows("documents")}
    want, got = plain.repeated(texts, 50), {r["doc_id"] for r in found}
    assert want == got
    for r in found:
        piece = texts[r["doc_id"]].encode()[r["start"] : r["end"]].decode(errors="ignore")
        assert abs(len(piece.split()) - r["n_words"]) <= 2


def test_passages_resist_shifts(docs):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    planted = [text(55) for _ in range(30)]
    short = text(30)
    given = []
    for i, p in enumerate(planted):
        given += [(2 * i, f"{text(rng.randrange(60))} {p} {text(40)} {short}", "a"), (2 * i + 1, f"{text(7)} {p} {short}", "b")]
    given += [(1000, text(300), "a"), (1001, None, "a"), (1002, "", "a"), (None, planted[0], "a"), (1000, text(20), "a")]
    found = chunks.repeated_passages(docs(given)).collect()
    assert {r["id"] for r in found} == set(range(60))
    assert all(r["first_id"] == r["id"] // 2 * 2 and r["n_words"] >= 50 for r in found)
    left = {r["doc_id"]: r["text"] for r in chunks.drop_repeated(docs(given)).filter("doc_id < 60").collect()}
    assert all(len(left[2 * i].split()) > 90 and len(left[2 * i + 1].split()) < 60 for i in range(30))
    assert chunks.repeated_passages(docs([])).count() == 0


def test_passages_whose_ends_stand_in_earlier_documents_too(docs):
    """The ends of passages just long enough also stand in documents of smaller ids, each end in one of its own."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    given = []
    for i in range(100):
        passage = text(rng.randrange(51, 61)).split()
        head, tail = (" ".join(p) for p in (passage[: rng.randrange(10, 15)], passage[-rng.randrange(10, 15) :]))
        given += [(i, f"{text(20)} {head} {text(20)}", "a"), (100 + i, f"{text(20)} {tail} {text(20)}", "a")]
        given += [(j + i, f"{text(rng.randrange(30))} {' '.join(passage)} {text(30)}", "a") for j in (200, 300)]
    # Passages of 40 words, and pieces of other documents next to each other, are not long enough.
    short, pieces = text(40), [text(30) for _ in range(4)]
    given += [(i, f"{text(20)} {short} {text(20)}", "a") for i in (400, 401)]
    given += [(402 + i, f"{text(20)} {p} {text(20)}", "a") for i, p in enumerate(pieces)]
    given += [(410, f"{text(20)} {' '.join(pieces)} {text(20)}", "a")]
    found = chunks.repeated_passages(docs(given)).collect()
    assert {r["id"] for r in found} == set(range(200, 400)) == plain.repeated({i: t for i, t, _ in given}, 50)
    assert all(r["first_id"] == 200 + r["id"] % 100 for r in found)


def test_passages_of_very_long_texts(docs):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(55)
    given = [(1, f"{text(100_000)} {passage} {text(100_000)}", "a"), (2, f"{text(9)} {passage} {text(9)}", "a"), (3, "ab" * 500_000, "a")]
    assert {r["id"] for r in chunks.repeated_passages(docs(given)).collect()} == {1, 2}


def test_first_copy_of_a_passage_stays_if_parts_of_it_stand_earlier(docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    long, pieces = text(1000), [text(25) for _ in range(8)]
    ordered = long.split()
    sentence, later = " ".join(ordered[400:430]), " ".join(ordered[700:])
    given = [(i, f"{text(20)} {p} {text(20)}", "a") for i, p in enumerate(pieces, 10)]
    given += [(2, f"{text(30)} {sentence} {text(30)}", "a"), (5, f"{text(20)} {long} {text(20)}", "a")]
    given += [(9, f"{text(20)} {long} {text(20)}", "a"), (8, f"{text(20)} {later} {text(60)}", "a")]
    # Every part of this passage stands in an earlier document, none of them holds it.
    given += [(i, f"{text(20)} {' '.join(pieces)} {text(20)}", "a") for i in (30, 31)]
    found = chunks.repeated_passages(docs(given)).collect()
    assert {(r["id"], r["first_id"]) for r in found} == {(5, 5), (9, 5), (8, 5), (30, 30), (31, 30)}
    assert all(r["n_words"] >= 50 for r in found)
    before = {i: t for i, t, _ in given}
    left = {r["doc_id"]: r["text"] for r in chunks.drop_repeated(docs(given)).collect()}
    assert {i for i in before if left[i] != before[i]} == {8, 9, 31}
    assert [len(left[i].split()) < 95 for i in (8, 9, 31)] == [True] * 3


def test_chunks_are_whole_and_alike_after_an_insertion():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(400)) + " la" * 200

    def cut(t):
        b, offsets = words.flat(pa.array([t, "", t]))
        ends = chunks.chunk_ends(b, offsets)
        pieces = [bytes(b[i:j]) for i, j in zip([0, *ends], ends)]
        assert b"".join(pieces) == t.encode() * 2
        return pieces[: len(pieces) // 2]

    assert len(set(cut(text)) ^ set(cut(text[:900] + "XY" + text[900:]))) <= 8


def test_numbers_of_a_chunk_share_two_longs(frame):
    names = ["id", "at", "size", "n_words", "lead", "lead_words", "tail", "tail_words", "digest"]
    rows = [(-5, (1 << 31) - 1, 32768, 16385, 32816, 16408, 32816, 16408, -7), (1, 0, 1, 0, 0, 0, 0, 0, 1 << 62), (2, 3, 4, 5, 6, 7, 8, 9, 10)]
    df = frame(", ".join(f"{n} {'long' if n in ('id', 'digest') else 'int'}" for n in names), rows)
    assert values(chunks._apart(chunks._together(df)).select(*names)) == sorted(rows, key=repr)


def test_no_chunk_is_longer_than_stated(monkeypatch):
    monkeypatch.setattr(chunks, "LONGEST", 40)
    text = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    ends = chunks.chunk_ends(text, np.array([0, 3000, 3000, 5000]))
    assert np.diff(np.concatenate(([0], ends))).max() <= 40 and {3000, 5000} <= set(ends.tolist())
