"""Source divergence: against brute force in Python's integers, and on awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.plain import LOWER
from tidemark.llm import divergence

DOCS = "doc_id long, text string, lang string, source string"


def brute_force(rows, min_docs, top=50):
    rows = [(t or "", l or "", s or "") for _, t, l, s in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def p(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (own[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = p(sum((counts[lang, s] for s in sources), Counter()))
        each = {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(each[s][t] - each[o][t]) for t in kept)) for o in sources - {s}]
            over = [(t, each[s][t] - q[t]) for t in kept if counts[lang, s][t] and each[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", over)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n) for n, (i, v) in enumerate(found, 1) if part == "pair" or n <= top]
    return sorted(out)


def found(df, **options):
    rows = divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in rows.collect())


def some(n, sources, seed=1):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(120)] + ["THE", "the", "ß", "𝒳", "1a2"]
    weight = {s: [rng.random() ** 4 for _ in words] for s in sources}
    rows = []
    for i in range(n):
        s = rng.choice(sources)
        rows.append((i, " ".join(rng.choices(words, weight[s], k=rng.randrange(40))), rng.choice(["en", "de", None]), s))
    return rows


def test_same_as_brute_force(frame):
    rows = some(300, ["a", "b", "c", "", None, "é"]) + [(None, None, None, None), (1, "", "fr", "z"), (2, "rare", "fr", "y")]
    df = frame(DOCS, rows).selectExpr("*", "1 AS n", "2 AS term", "3 AS vector", "4 AS total")
    assert found(df, min_docs=10) == brute_force(rows, 10)


def test_blocks_and_tiles(frame, monkeypatch):
    """Few terms and sources a block: every pair is put together from many."""
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)
    rows = some(400, [f"s{i}" for i in range(17)], seed=2)
    assert found(frame(DOCS, rows), min_docs=8, top=3) == brute_force(rows, 8, 3)


def test_nothing_kept_and_nothing_there(frame):
    rows = [(1, "a b", "en", "x"), (2, "a c", "en", "y"), (3, "a", "de", "x")]
    assert found(frame(DOCS, rows)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert found(frame(DOCS, [])) == []


@pytest.mark.parametrize("repeat", [1, 3])
def test_repeated_rows_and_a_long_text(frame, repeat):
    rows = (some(60, ["a", "b"], seed=3) + [(7, "wa long " * 50_000, "en", "a")]) * repeat
    assert found(frame(DOCS, rows), min_docs=5) == brute_force(rows, 5)


def test_a_task_adds_up_what_its_documents_hold(frame, monkeypatch):
    """Rows told together name a term once for each power of two in its number, and for no more documents than asked."""
    rows = [(i, "wa wb " * 3 + "wc", "en", "x") for i in range(40)] + [(50, "Wa", "en", "y"), (51, None, "", None)]
    docs = frame(DOCS, rows).selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source", "coalesce(text, '') AS text")
    told = divergence.marked_terms(docs.coalesce(1), 7).collect()
    assert sum(len(r["seen"]) for r in told if r["seen"]) == 3 * 7
    sums = Counter()
    for r in told:
        for t in r["terms"] or []:
            sums[r["lang"], r["source"], t.split(divergence.JOINT)[0]] += r["weight"]
    assert sums == {("en", "x", "wa"): 120, ("en", "x", "wb"): 120, ("en", "x", "wc"): 40, ("en", "y", "wa"): 1}
    assert sum(len(r["terms"]) for r in told if r["terms"]) == 4 + 4 + 2 + 1
    monkeypatch.setattr(divergence, "TOGETHER", 1)
    monkeypatch.setattr(divergence, "HELD", 8)
    rows = some(700, ["a", "b", None], seed=4)
    assert found(frame(DOCS, rows), min_docs=20) == brute_force(rows, 20)


def test_documents_of_a_term_are_added_up_over_all_tasks(frame, monkeypatch):
    """A term is in as many rows as documents hold it or as are asked for, however many tasks meet it, and in none twice."""
    monkeypatch.setattr(divergence, "TOGETHER", 1)
    monkeypatch.setattr(divergence, "ROW", 2)
    rows = [(i, "wa wa" + " wb" * (i < 5), ["en", "fr"][i % 20 == 0], "x") for i in range(80)]
    told = divergence.marked_terms(frame(DOCS, rows).select("lang", "source", "text").repartition(6), 7).collect()
    seen = [r["seen"] for r in told if r["seen"]]
    assert all(len(s) == len(set(s)) for s in seen)
    number = Counter(tuple(t.split(divergence.JOINT)) for s in seen for t in s)
    code = {lang: lang.encode().hex().upper() for lang in ("en", "fr")}
    assert number == {("wa", code["en"]): 7, ("wa", code["fr"]): 4, ("wb", code["en"]): 4, ("wb", code["fr"]): 1}
