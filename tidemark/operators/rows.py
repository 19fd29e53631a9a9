"""Duplicates, ordering, comparison and cursors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import SKEW_MIN_ROWS, freeing, setting

#: Hash buckets in which a comparison counts rows, to find those with too many for one task.
BUCKETS = 1024

#: Rows of a side that one task should count at most, so that it need not spill them.
TASK_ROWS = 500_000

#: Types whose equal values have equal bytes, and so one hash wherever it is taken.
PLAIN = (T.BooleanType, T.IntegralType, T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType)
PLAIN += (T.TimestampNTZType,)

Sums = dict[int, tuple[int, ...]]


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def total_order(columns: Sequence[str], order: Sequence[str], first: Sequence[Column] = ()) -> Column:
    """The whole row as one comparable struct: leading terms, declared order, then all other columns.

    A struct is never null, so a null in an order column loses no row, and ties are broken by content.
    """
    rest = [c for c in columns if c not in order]
    return F.struct(*first, *_quoted(order), *_quoted(rest))


def collapse(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last in the declared order.

    A plain min or max of the row struct, so copies of a hot key are reduced before the shuffle.
    """
    pick = {"first": F.min, "last": F.max}[keep]
    payload = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(total_order(payload, order)).alias("__row"))
    return best.select([F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def sort_for_layout(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order rows inside each output file; no global sort."""
    return df.sortWithinPartitions(*columns)


def high_water_mark(df: DataFrame, cursor: str) -> int:
    """Largest cursor value, 0 for none."""
    return int(df.agg(F.coalesce(F.max(cursor), F.lit(0))).first()[0])


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row. Null flags keep (null, a) apart from (a, null)."""
    terms = [t for c in _quoted(columns) for t in (c.isNull(), c)]
    return F.xxhash64(F.lit(seed), *terms)


def multiset_sums(columns: Sequence[str]) -> list[Column]:
    """Order-free fingerprint of a set of rows: a count and the sums of two 64-bit row hashes.

    Each hash is summed in pieces of 22 bits, so that a sum stays exact for up to 2^41 rows.
    """
    sums = [F.count(F.lit(1)).alias("rows")]
    for seed in (1, 2):
        h = row_hash(columns, seed)
        for shift in (0, 22, 44):
            piece = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 22) - 1))
            sums.append(F.sum(piece).alias(f"h{seed}_{shift}"))
    return sums


def _plain(df: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, PLAIN)]


def _bucket(columns: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int") if columns else F.lit(0)


def _fingerprints(a: DataFrame, b: DataFrame) -> tuple[Sums, Sums]:
    """Count and sums of both frames by hash bucket of their plain columns: one scan of each, no shuffle of rows."""
    both = a.withColumn("__side", F.lit(0)).unionByName(b.withColumn("__side", F.lit(1)))
    keyed = both.groupBy("__side", _bucket(_plain(both.drop("__side"))).alias("__bucket"))
    found: tuple[Sums, Sums] = ({}, {})
    for side, bucket, *sums in keyed.agg(*multiset_sums(a.columns)).collect():
        found[side][bucket] = tuple(sums)
    return found


def same_fingerprint(a: DataFrame, b: DataFrame) -> bool:
    """Compare both frames by fingerprint: one scan of each, no shuffle of rows."""
    left, right = _fingerprints(a, b)
    return left == right


def _dealing(df: DataFrame, sums: Sums) -> tuple[list[int], int]:
    """The buckets with more rows than one task should read, and the number of tasks for the others."""
    spark = df.sparkSession
    counts = {bucket: rows for bucket, (rows, *_) in sums.items()}
    total = sum(counts.values())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_ROWS)
    share = max(total // tasks, setting(spark, SKEW_MIN_ROWS))
    return sorted(bucket for bucket, rows in counts.items() if rows > max(2 * share, 8 * total // BUCKETS)), tasks


def signed_counts(a: DataFrame, b: DataFrame, hot: Sequence[int] | None = None, tasks: int = 0) -> DataFrame:
    """Rows that occur more often on one side, with ``surplus`` = copies in ``a`` minus copies in ``b``.

    Copies are added up in the task that reads them, before rows are shuffled, as one row may have very many. ``hot``
    states in which buckets there are many, if any, for frames with the same types: all other rows are then dealt by
    their plain columns as they are, and counted where they meet. The optimizer drops a shuffle that a side ends with, as
    rows are dealt anew right after it, and runs one shuffle if both sides come down to the same. ``tasks`` states over
    how many tasks they are dealt, if these are more than the session has.
    """
    if hot is None:
        both = a.withColumn("__sign", F.lit(1)).unionByName(b.withColumn("__sign", F.lit(-1)))
        return both.groupBy(*_quoted(a.columns)).agg(F.sum("__sign").alias("surplus")).filter("surplus <> 0")
    columns = _plain(a)
    if not hot:
        more = tasks > int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        deal = [tasks, *columns] if more else columns
        return signed_counts(a.repartition(*deal), b.repartition(*deal))
    many = _bucket(columns).isin(list(hot))
    few = signed_counts(a.filter(~many), b.filter(~many), [], tasks)
    return few.unionByName(signed_counts(a.filter(many), b.filter(many)))


def same_rows(a: DataFrame, b: DataFrame, exact: bool = True) -> bool:
    """Do both frames hold the same rows, each as often, in whatever order?

    Different fingerprints settle it without shuffling a row. Equal ones (chance of error about 2^-128) are
    confirmed by signed counts if ``exact``. Both frames are read twice then: stage what is dear to compute.
    """
    b = b.select(*_quoted(a.columns))
    with freeing(a.sparkSession):
        left, right = _fingerprints(a, b)
        if left != right:
            return False
        if not exact:
            return True
        alike = _plain(a) and a.dtypes == b.dtypes
        return signed_counts(a, b, *(_dealing(a, left) if alike else ())).isEmpty()


def diff_rows(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing in the target, extra in it, or changed. Keys are unique on both sides."""
    left = src.select(*keys, row_hash(src.columns, 1).alias("s1"), row_hash(src.columns, 2).alias("s2"))
    right = tgt.select(*keys, row_hash(src.columns, 1).alias("t1"), row_hash(src.columns, 2).alias("t2"))
    status = (
        F.when(F.col("t1").isNull(), "missing")
        .when(F.col("s1").isNull(), "extra")
        .when((F.col("s1") != F.col("t1")) | (F.col("s2") != F.col("t2")), "changed")
    )
    joined = left.join(right, list(keys), "full_outer")
    return joined.select(*keys, status.alias("status")).filter("status is not null")
