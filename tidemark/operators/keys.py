"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage, staging

MAX_BROADCAST_FILES = 200_000


def number_staged(staged: DataFrame, start: int = 0, name: str = "id", by: str | None = None) -> DataFrame:
    """Ids start+1, start+2, … for a frame read from parquet files: rows before this file + position in the file.

    The files never change, so the ids come out the same however often a task is repeated. No row is shuffled;
    only one count per file is summed up. ``by`` is a column the folder is partitioned by: each part is numbered on its own.
    """
    columns = staged.columns
    placed = staged.select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index")
    )
    file = ["__file", *([by] if by else [])]
    before = Window.partitionBy(by) if by else Window
    before = before.orderBy(F.length("__file"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*file)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*file, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    # One row per file: the number of files bounds what is broadcast.
    if len(staged.inputFiles()) <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    numbered = placed.join(offsets, file)
    key = (F.lit(start) + F.col("__before") + F.col("__index") + 1).cast("long")
    return numbered.select(key.alias(name), *[F.col(f"`{c}`") for c in columns])


def assign_ids(df: DataFrame, start: int = 0, order_by: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """Number the rows densely after ``start``, in arrival order or in the given order.

    The ordered form sorts by range over many tasks. The position of a row in its file of a first copy breaks ties, so
    even a large group of equal rows is split; that copy is removed. The result reads one copy in ``folder`` (by default
    the shared folder), which lasts as long as the caller needs it.
    """
    if not order_by:
        return number_staged(stage(df, folder), start)
    with staging(df.sparkSession) as passing:
        # The position alone: unlike a hash it takes next to nothing in the shuffle.
        ranged = stage(df, passing).withColumn("__tie", F.col("_metadata.row_index"))
        ranged = ranged.repartitionByRange(*order_by, "__tie").sortWithinPartitions(*order_by, "__tie")
        return number_staged(stage(ranged.drop("__tie"), folder), start)
