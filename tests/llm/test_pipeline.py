"""The pipeline against a plain version of its stages."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_DIR, values
from tests.llm import plain
from tidemark.llm import decontaminate, quality

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_stages_equal_a_plain_version(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps, frames = dict(corpus_pipeline.STAGES), []
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SF_DIR)
        docs = docs.checkpoint()
        assert docs.columns == DOCS
        frames.append([r.asDict() for r in docs.collect()])
    scored, lined, single, clean = frames

    raw = rows("documents")
    model = quality.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scorer = quality.Scorer(model)
    good = [d for d in raw if scorer.score((d["text"] or "").encode()) >= 0.5]
    assert sorted(d["doc_id"] for d in scored) == sorted(d["doc_id"] for d in good)

    want = plain.without_frequent_lines(good, 0.1, 3)
    assert {d["doc_id"]: d["text"] for d in lined} == {d["doc_id"]: t for d, t in zip(good, want)}

    lined.sort(key=lambda d: d["doc_id"])
    roots = plain.groups([d["text"] for d in lined], 5, 80)
    assert sorted(d["doc_id"] for d in single) == [d["doc_id"] for i, d in enumerate(lined) if roots[i] == i]

    items = [decontaminate.normal(r["text"]) for r in rows("benchmark")]
    leak = {d["doc_id"] for d in single if any(i in decontaminate.normal(d["text"]) for i in items)}
    assert leak and leak.isdisjoint(d["doc_id"] for d in clean)
    assert len(single) - len(clean) <= len(leak) + 2

    mixed = steps["mixing sources"](spark, docs, SF_DIR)
    sizes = {}
    for d in clean:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(plain.WORD.findall(d["text"]))
    taken = dict(mixed.groupBy("source").agg(F.sum("mix_taken")).collect())
    from tests.llm.test_texts import water_fill

    target = water_fill(sizes, (3, 1, 2), 2)
    assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    again = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "mix_epoch", "mix_taken")
    assert values(again) == values(mixed.select("doc_id", "mix_epoch", "mix_taken"))


def test_stages_on_awkward_rows(spark, frame):
    text = "one two three four five six seven"
    given = [(1, text, "en", "a", 1), (None, text, None, None, None), (1, text, "en", "a", 1), (2, None, "x", None, 0), (3, "", "x", "a", 0)]
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", given)
    for df in (docs, docs.limit(0)):
        for _, apply in corpus_pipeline.STAGES:
            df = apply(spark, df, SF_DIR).checkpoint()
            assert df.columns[:5] == DOCS
            df = df.select(*DOCS)
