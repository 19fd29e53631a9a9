"""Quality classifier by compression: zstandard dictionaries of good and of bad labelled text.

A text is compressed piece by piece, once with each dictionary; the difference of the two sizes over their sum says
which kind of text it is like. A logistic curve over that difference, the compression ratio and the length, fitted on
labelled rows that no dictionary has seen, makes it a probability.

Labels are read only for documents whose crc32(id as text) mod 3 is not 1; the rest are held out. The classifier is
fitted on a bounded sample: of each class the SAMPLE_ROWS labelled documents that come first by a hash of their id,
and of these as many as hold SAMPLE_BYTES of text. Scoring covers every document and its whole text.

An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts, packed
from tidemark.session import stage

SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 12 << 20
#: Texts are compressed in pieces of so many bytes, so that the dictionary counts in long texts too.
PIECE = 512
DICTIONARY = 112_640
LEVEL = 3
RIDGE = 1e-2


@dataclass(frozen=True)
class Model:
    """The dictionaries of bad and good text (None if labels lack a class) and the curve's weights."""

    bad: bytes | None
    good: bytes | None
    weights: tuple[float, ...]


def fold(id: Column) -> Column:
    """Documents of fold 1 are held out."""
    return F.crc32(id.cast("string").cast("binary")) % 3


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the text itself serves as one
        return b"\n".join(texts)[:DICTIONARY]


class Scorer:
    """Scores texts with a model; made once per task, as compressors do not travel."""

    def __init__(self, model: Model):
        self.weights = np.array(model.weights)
        self.sides = [self._compressor(d) for d in (model.bad, model.good)] if model.bad and model.good else []

    @staticmethod
    def _compressor(dictionary: bytes):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **options)

    def features(self, text: bytes) -> list[float]:
        bad, good = (
            sum(len(side.compress(text[i : i + PIECE])) for i in range(0, max(len(text), 1), PIECE)) for side in self.sides
        )
        differ = 20 * (bad - good) / (bad + good)
        ratio = np.log((good + 1) / (len(text) + 1))
        length = np.log(len(text) + 1) / 5
        return [1.0, differ, ratio, length, differ * length, ratio * ratio]

    def score(self, text: bytes) -> float:
        logit = self.weights @ self.features(text) if self.sides else self.weights[0]
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _fit(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton's method; ``share`` weighs the rows."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - RIDGE * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from the labelled documents that are not held out. Labels other than 0 and 1 are ignored.

    Brings at most 2 * SAMPLE_ROWS texts of at most 2 * SAMPLE_BYTES to the driver. Every second of them trains the
    dictionaries, the others the curve, weighted to the classes' true shares. Without both classes the model gives
    the share of good labels (0.5 without labels) to every text.
    """
    known = labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & (fold(F.col("id")) != 1)).distinct()
    known = known.join(docs.select(F.col(id).cast("long").alias("id")).distinct(), "id", "left_semi")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
        return Model(None, None, (float(np.log(share / (1 - share))),))
    order = F.md5(F.concat(F.lit("sample"), F.col("id").cast("string")))
    first = [known.filter(F.col("y") == y).orderBy(order, "id").limit(SAMPLE_ROWS) for y in (0, 1)]
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chosen = F.broadcast(first[0].union(first[1]))  # at most 2 * SAMPLE_ROWS pairs of numbers
    sample = rows.join(chosen, F.col("doc") == F.col("id")).select("id", "y", order.alias("rank"), "text")
    sample = stage(sample.dropDuplicates(["id", "y"]))
    sizes = sample.select("id", "y", "rank", F.octet_length("text").alias("size")).collect()
    kept, used = [], {0: 0, 1: 0}
    for row in sorted(sizes, key=lambda r: (r["rank"], r["id"])):
        if used[row["y"]] + row["size"] <= SAMPLE_BYTES:
            used[row["y"]] += row["size"]
            kept.append(row["id"])
    texts = sample.filter(F.col("id").isin(kept)).collect() if kept else []
    texts = sorted(texts, key=lambda r: (r["rank"], r["id"], r["y"]))
    by_class = {y: [r["text"].encode() for r in texts if r["y"] == y] for y in (0, 1)}
    model = Model(*[_dictionary(by_class[y][::2] or [b" "]) for y in (0, 1)], (0.0,))
    scorer = Scorer(model)
    held = [(t, y) for y in (0, 1) for t in (by_class[y][1::2] or by_class[y])]
    x = np.array([scorer.features(t) for t, _ in held])
    y = np.array([y for _, y in held], dtype=float)
    share = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
    return Model(model.bad, model.good, tuple(_fit(x, y, share * len(y) / share.sum()).tolist()))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct and the probability that its text is good; null is empty."""
    rows = packed(docs).withColumn("text", F.coalesce(F.col(f"row.{text}"), F.lit("")))

    def work(batch: pa.RecordBatch):
        if not scorer:
            scorer.append(Scorer(model))
        scores = [scorer[0].score(t.encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    scorer: list[Scorer] = []
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    return map_texts(rows, work, schema, "text")


def score_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) per row; a row without an id counts as not held out."""
    model = train(docs, labels, id, text)
    found = scored(docs.select(id, text), model, text)
    held_out = F.coalesce(fold(F.col(f"row.{id}")) == 1, F.lit(False))
    predicted = (F.col("score") >= 0.5).cast("int")
    return found.select(F.col(f"row.{id}").alias("id"), held_out.alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores below 0.5."""
    return scored(docs, train(docs, labels, id, text), text).filter("score >= 0.5").select("row.*")
