"""URL filter: allow and block rules, and for the rest two variable-order Markov models of URL characters.

One model learns the URLs that rules allow, the other those that rules block. A URL's score is the difference of their
log-likelihoods over its length; the threshold is calibrated on URLs that neither model has learned from. A character's
probability is taken from the longest context that was seen and smoothed, order by order, with the shorter ones.

Every context and every character in a context is counted, by 64-bit hash, over all URLs with a rule but the fifth that
calibrates. The counts are added up by Spark and written to files that grow with them and that the tasks map into memory;
no table of them passes through the driver. An empty table gives no rows; without rules that fit, every score is 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts
from tidemark.llm.hashcounts import HashCounts, write_counts
from tidemark.llm.words import U, flat, mix, salt
from tidemark.session import shared_dir, staging

# (verdict, host, path) of the contract's rules: fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 5
SIDES = ("allow", "block")
#: Weight of the shorter context's probability, as so many characters seen.
BACK_OFF = 4.0
#: One in so many URLs calibrates instead of teaching.
CALIBRATE = 5
BINS = 400
RANGE = 4.0

Rules = Sequence[tuple[str, str, str]]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Rules = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path) and its verdict, or nulls.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _keys(b: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For orders 0, 1, ... a hash of each character in the context of so many before it, and of that context alone.

    Contexts reach back to a start mark of the URL, not beyond.
    """
    start = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(len(b)) - start
    context = np.zeros(len(b), dtype=U)
    for order in range(ORDER + 1):
        if order:
            back = np.arange(len(b)) - order
            char = np.where(at >= order, b[np.maximum(back, 0)].astype(U) + U(1), U(0))
            context = mix(context * salt(order) + char + U(order))
        yield mix(context + (b.astype(U) + U(1)) * salt(60)), mix(context + salt(61))


def _of_side(hashes: np.ndarray, side: int) -> np.ndarray:
    return mix(hashes ^ salt(70 + side))


@dataclass(frozen=True)
class Model:
    """Counts of characters in contexts and of contexts, of allowed and of blocked URLs, and the threshold."""

    counts: HashCounts
    threshold: float

    def scores(self, urls: pa.Array) -> np.ndarray:
        """Log-likelihood difference over the length in bytes, positive for allowed; 0 for an empty URL."""
        b, offsets = flat(urls)
        keys = [_of_side(k, side) for pair in _keys(b, offsets) for side in (0, 1) for k in pair]
        found = iter(self.counts[np.concatenate(keys)].reshape(len(keys), len(b)) if len(b) else np.zeros((len(keys), 0)))
        total = [np.full(len(b), 1 / 256), np.full(len(b), 1 / 256)]
        for _ in range(ORDER + 1):
            for side in (0, 1):
                own, seen = next(found), next(found)
                total[side] = (own + BACK_OFF * total[side]) / (seen + BACK_OFF)
        sums = np.concatenate(([0.0], np.cumsum(np.log(total[0]) - np.log(total[1]))))
        lengths = np.diff(offsets)
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(lengths, 1)


def count_keys(labelled: DataFrame) -> DataFrame:
    """(hash, n): contexts, and characters in them, of the URLs (url, verdict) of each side; added up in each task first."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        verdicts = batch.column("verdict").to_numpy(zero_copy_only=False)
        keys = [np.zeros(0, dtype=U)]
        for side, verdict in enumerate(SIDES):
            b, offsets = flat(batch.column("url").filter(pa.array(verdicts == verdict)))
            keys += [_of_side(k, side) for pair in _keys(b, offsets) for k in pair]
        hashes, n = np.unique(np.concatenate(keys), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    parts = map_texts(labelled.select("url", "verdict"), work, "hash long, n long", "url")
    return parts.groupBy("hash").agg(F.sum("n").alias("n"))


def train(judged: DataFrame) -> Model:
    """A model from all rows of (url, verdict) that have both; one URL in CALIBRATE sets the threshold instead.

    The threshold is where the share of allowed URLs below it and of blocked ones above it are least together; 0 if
    one of the two is missing.
    """
    known = judged.filter(F.col("verdict").isNotNull() & F.col("url").isNotNull())
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(CALIBRATE)) == 0
    spark = judged.sparkSession
    with staging(spark) as own:
        counts = write_counts(count_keys(known.filter(~held)), f"{shared_dir(spark)}/urls-{uuid.uuid4().hex}", own)
    model = Model(counts, 0.0)
    place = F.floor((F.greatest(F.lit(-RANGE), F.least("score", F.lit(RANGE))) + RANGE) / (2 * RANGE) * BINS)
    bins = scored(known.filter(held), model).groupBy("verdict", place.alias("bin")).agg(F.count("*").alias("n"))
    below = {kind: np.zeros(BINS + 1) for kind in ("allow", "block")}
    for row in bins.collect():  # at most two rows a bin
        below[row["verdict"]][row["bin"]] += row["n"]
    if not all(b.sum() for b in below.values()):
        return model
    lost = np.cumsum(below["allow"]) / below["allow"].sum()
    let = 1 - np.cumsum(below["block"]) / below["block"].sum()
    best = np.flatnonzero(lost + let == (lost + let).min())
    return Model(counts, float((best.mean() + 1) * 2 * RANGE / BINS - RANGE))


def scored(urls: DataFrame, model: Model) -> DataFrame:
    """``urls`` with one more column, ``score``; a null url scores as an empty one."""
    def work(batch: pa.RecordBatch):
        scores = pa.array(model.scores(batch.column("url")))
        yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return map_texts(urls, work, urls.withColumn("score", F.lit(0.0)).schema, "url")


def judge(pages: DataFrame, id: str = "page_id", url: str = "url", rules: Rules = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score) per row: the rule's verdict, else the models'.

    ``score`` is null where a rule decides. An empty or null url fits no rule and scores 0, which is allowed if the
    threshold is not above it. Repeated rows are judged alike and each teaches.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    rows = rows.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"))
    model = train(rows.select("url", "verdict"))
    found = scored(rows, model)
    own = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    score = F.when(F.col("rule").isNull(), F.col("score"))
    return found.select("id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), score.alias("score"))
