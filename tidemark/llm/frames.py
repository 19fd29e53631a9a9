"""Frames: finding few rows of a large table by key, freeing finished shuffles, and Arrow batches in Python tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the table that :func:`prefiltered` broadcasts: at most BITS / 64 rows, whatever the number of keys.
BITS = 1 << 22
#: Bytes of text that a Python task works on at a time (one longer text is worked on alone).
BATCH_BYTES = 4 << 20
#: Rows of an Arrow batch: bounds what the JVM sends at once.
BATCH_ROWS = 512


def _marked(df: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """``df`` with ``_pick_hit``: false for rows whose keys are surely not in ``wanted``.

    A bit table of the wanted keys, of a fixed size, is broadcast. Null keys count as equal.
    """
    bit = lambda names: F.pmod(F.xxhash64(*[F.col(n) for n in names]), F.lit(BITS))
    words = (
        wanted.select(bit(wanted_keys).alias("b"))
        .groupBy(F.shiftright("b", 6).alias("_pick_at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("_pick_bits"))
    )
    near = df.withColumn("_pick_b", bit(keys))
    near = near.join(F.broadcast(words), F.shiftright("_pick_b", 6) == F.col("_pick_at"), "left")
    hit = F.expr("_pick_bits & shiftleft(1L, cast(_pick_b & 63 as int))") != 0
    return near.withColumn("_pick_hit", F.coalesce(hit, F.lit(False))).drop("_pick_b", "_pick_at", "_pick_bits")


def prefiltered(df: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys are in ``wanted`` and a few more, before anything wide is shuffled.

    The join that follows is exact and shuffles only what is left.
    """
    return _marked(df, keys, wanted, wanted_keys).filter("_pick_hit").drop("_pick_hit")


def surely_not(df: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """The rows that :func:`prefiltered` leaves out."""
    return _marked(df, keys, wanted, wanted_keys).filter("not _pick_hit").drop("_pick_hit")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now rather than at its next periodic cleaning."""
    gc.collect()
    spark._jvm.System.gc()


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no working column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def map_texts(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType, text: str
) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_BYTES of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            start = total = 0
            for i, n in enumerate(lengths):
                if i > start and total + n > BATCH_BYTES:
                    yield from work(batch.slice(start, i - start))
                    start, total = i, 0
                total += n
            if len(lengths) > start:
                yield from work(batch.slice(start))

    return small_batches(df).mapInArrow(run, schema)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session set to send Python tasks at most BATCH_ROWS rows at a time."""
    conf, rows = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(rows)) > BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    return df
