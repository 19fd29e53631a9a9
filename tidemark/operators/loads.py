"""The load protocols as pure functions of a source and a target frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import month_number
from tidemark.operators.joins import new_rows, spread_join
from tidemark.operators.rows import collapse, distinct, row_hash, total_order
from tidemark.session import stage


def append_above(src: DataFrame, mark: int, cursor: str) -> DataFrame:
    """Rows to append: cursor strictly above the mark.

    The mark is a literal, so the filter reaches the scan that owns the cursor. Rows without a cursor stay in, for
    the not-null rule to find them.
    """
    return src.filter((F.col(cursor) > F.lit(mark)) | F.col(cursor).isNull())


def insert_absent(src: DataFrame, tgt: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to append: the first row of each key the target does not hold."""
    return new_rows(collapse(src, keys, order, "first"), tgt, keys, skew=None)


def absent_keys(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys an insert would add. Only keys are shuffled; a hot key is reduced before that."""
    return new_rows(src.select(*keys).distinct(), tgt, keys, skew=None)


def insert_keys(src: DataFrame, chosen: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to append for a small set of keys known to be absent: no other source row is shuffled."""
    rows = spread_join(src, chosen, [(k, k) for k in keys], "left_semi", null_safe=True, small=True)
    return collapse(rows, keys, order, "first")


def merge(src: DataFrame, tgt: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Next target state: the last source row of each key, else the target's row. Whole rows are picked.

    Both sides go through one grouping, in which any source row outranks the target's.
    """
    both = tgt.select(*src.columns).withColumn("__new", F.lit(False)).unionByName(src.withColumn("__new", F.lit(True)))
    payload = [c for c in src.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max(total_order(payload, order, [F.col("__new")])).alias("__row"))
    return best.select([F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in src.columns])


def upsert(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str] = (),
    unique_source: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Next target state: every target row whose key is in the source takes its update columns; source rows
    with a key unknown to the target are added. Target rows without source stay.

    ``unique_source`` states that no key comes twice in the source; then one full outer join does it all. Else the
    distinct source is written once, to ``folder`` or the shared folder, and read back by both parts.
    """
    if unique_source:
        return _upsert_unique(src, tgt, keys, update)
    staged = stage(distinct(src), folder)
    return matched_update(staged, tgt, keys, update, order).unionByName(new_rows(staged, tgt, keys))


def _upsert_unique(src: DataFrame, tgt: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    columns = tgt.columns
    fresh = src.select(*[F.col(c).alias(f"__s_{c}") for c in columns], F.lit(True).alias("__new"))
    held = tgt.withColumn("__held", F.lit(True))
    same_key = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__s_{k}") for k in keys])

    def pick(c: str) -> Column:
        newer = F.col("__held").isNull() | F.col("__new") if c in update else F.col("__held").isNull()
        return F.when(newer, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)

    return held.join(fresh, same_key, "full_outer").select([pick(c) for c in columns])


def matched_update(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """All target rows, the matched ones with the update columns of the source (the last row of a repeated key)."""
    fresh = collapse(src.dropna(subset=list(keys)), keys, order, "last")
    packed = fresh.select(*keys, F.struct(*update).alias("__fresh"))
    joined = spread_join(tgt, packed, [(k, k) for k in keys], "left")

    def pick(c: str) -> Column:
        return F.when(F.col("__fresh").isNotNull(), F.col("__fresh")[c]).otherwise(F.col(c)).alias(c)

    return joined.select([pick(c) if c in update else F.col(c) for c in tgt.columns])


def touched_months(src: DataFrame, tgt: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Months a merge or upsert has to rewrite: with ``matched``, the number of matched target rows, and ``most``, the
    largest number of source rows of one key.

    A key is touched if it has a source row and its rows are not all equal to one another and to a target row. Its
    months are those of all its rows, on either side. Target rows matched but not touched count under a null month.
    A missing day is a month of its own. A key's months are as many as it has rows of different months.
    Only keys and row hashes are shuffled, combined map-side, in one grouping of both sides.
    """
    columns = src.columns

    def narrow(df: DataFrame, is_source: bool) -> DataFrame:
        hashes = [row_hash(columns, seed).alias(f"__h{seed}") for seed in (1, 2)]
        return df.select(*keys, *hashes, month_number(day).alias("__m"), F.lit(int(is_source)).alias("__s"))

    per_key = (
        narrow(src, True)
        .unionByName(narrow(tgt, False))
        .groupBy(*keys)
        .agg(
            F.min("__h1").alias("lo1"),
            F.max("__h1").alias("hi1"),
            F.min("__h2").alias("lo2"),
            F.max("__h2").alias("hi2"),
            F.collect_set("__m").alias("months"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("__s").alias("sources"),
        )
    )
    keyless = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    targets = F.col("rows") - F.col("sources")
    differs = (F.col("lo1") != F.col("hi1")) | (F.col("lo2") != F.col("hi2"))
    touched = (F.col("sources") > 0) & (keyless | (targets == 0) | differs)
    matched = F.when((F.col("sources") > 0) & ~keyless, targets).otherwise(0)
    spread = per_key.select(
        matched.alias("matched"), "sources", F.posexplode_outer(F.when(touched, F.col("months"))).alias("n", "month")
    )
    once = F.when(F.coalesce("n", F.lit(0)) == 0, F.col("matched")).otherwise(0)
    return spread.groupBy("month").agg(F.sum(once).alias("matched"), F.max("sources").alias("most"))


def merge_counts(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (inserted, updated): keys new to the target, and all other source rows, changed or not."""
    fresh = absent_keys(src, tgt, keys).agg(F.count(F.lit(1)).alias("inserted"))
    rows = src.agg(F.count(F.lit(1)).alias("rows"))
    both = fresh.select("inserted", F.lit(0).alias("rows")).unionByName(rows.select(F.lit(0).alias("inserted"), "rows"))
    return both.agg(F.sum("inserted").alias("inserted"), (F.sum("rows") - F.sum("inserted")).alias("updated"))
