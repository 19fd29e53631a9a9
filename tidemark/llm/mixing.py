"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source the keys are cut into ranges of equal width, which hold about
equally many documents; each range is sorted by itself, and the sums of the ranges before it turn its running sums
into those of the whole source. The mix takes documents in key order up to the source's exact budget of words.

An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.frames import packed
from tidemark.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
EPOCHS = 2
#: Hexadecimal digits that name a range: 4,096 ranges a source.
DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(name, source_size, target) from (name, source, size), a row per document.

    Sources by code point, null last, take the weights in turn and share SHARE of all words. A source's target stops
    at ``epochs`` times its size and the excess goes to the others by weight. That is settled in one pass: sources in
    the order in which they reach their limit, each with the level that the words left would give. Windows over all
    sources see one row per source, never documents.
    """
    totals = sizes.groupBy("name", "source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = totals.withColumn("w", weight).withColumn("limit", F.col("source_size") * float(epochs))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    words = F.sum("source_size").over(every) * SHARE[0] / SHARE[1]
    left = words - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weights_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / weights_left).withColumn("at", F.row_number().over(order))
    free = F.when(F.col("level") * F.col("w") < F.col("limit"), F.col("at"))
    level = level.withColumn("free_level", F.min_by("level", free).over(every))
    target = F.least(F.col("limit"), F.coalesce(F.col("free_level") * F.col("w"), F.col("limit")))
    return level.select("name", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """(id, source, size, source_size, target, taken) per document.

    ``size`` counts the text's words (null: 0). ``taken`` are the words that the mix takes, repeats counted: each
    whole epoch takes the document, the last one what its source's budget has left when its turn comes. A source's
    taken words are its target without the fraction; none exceeds ``epochs`` times its size. The order depends on id
    and size alone, so reruns agree and equal rows may stand for each other. Null ids and sources are kept; a source
    without words has target 0.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    read = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size.alias("size"))
    label = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("|"), F.col("size").cast("string"))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    narrow = stage(read.select("*", name.alias("name"), F.substring(F.md5(label), 1, 16).alias("key")))
    narrow = narrow.withColumn("range", F.substring("key", 1, DIGITS))
    targets = source_targets(narrow, weights, epochs)

    ranges = narrow.groupBy("name", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    ranges = ranges.join(targets, "name")

    within = Window.partitionBy("name", "range").orderBy("key", "id", "size")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = narrow.withColumn("running", running).join(ranges, ["name", "range"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor("target") - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("running")))
    taken = (whole * F.col("size") + part).cast("long")
    return placed.select("id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, each once per epoch it appears in, with the words taken there.

    Rows are ``docs`` with two more columns, ``mix_epoch`` (from 1) and ``mix_taken`` (existing columns of these
    names are replaced). Rows of equal id and size are interchangeable to the mix, so each gets the same share:
    the mean of theirs, rounded up, which differs from the budget by less than one word a row.
    """
    id, text = options.get("id", "doc_id"), options.get("text", "text")
    mix = mix_sources(docs, **options)
    share = mix.groupBy("id", "source", "size").agg(F.ceil(F.avg("taken")).alias("share"))
    size = F.coalesce(F.regexp_count(F.col(f"row.{text}"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = packed(docs).withColumn("words", size)
    same = (
        F.col(f"row.{id}").eqNullSafe(F.col("id"))
        & F.col(f"row.{options.get('source', 'source')}").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size"))
    )
    joined = rows.join(share.filter(F.col("share") > 0), same)
    last = F.ceil(F.col("share") / F.col("size"))
    joined = joined.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    taken = F.least(F.col("size"), F.col("share") - (F.col("epoch") - 1) * F.col("size"))
    columns = [c for c in docs.columns if c not in ("mix_epoch", "mix_taken")]
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in columns], F.col("epoch").alias("mix_epoch"), taken.alias("mix_taken")
    )
