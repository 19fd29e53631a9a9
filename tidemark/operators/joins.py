"""Joins that hold up when one key carries a large share of the rows.

A side proven small is broadcast. Otherwise the left side's keys are counted in a fixed number of hash buckets
(one pass over the key columns, combined map-side). Rows in overfull buckets get a salt and the matching right
rows are repeated once per salt, so a hot key is spread over many tasks and the result stays whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sizing import estimated_small, input_bytes, measured_small, multiplies
from tidemark.session import SKEW_MIN_BYTES, SKEW_MIN_ROWS, setting

BUCKETS = 16_384
SALT = "__salt"
MEASURE = "measure"

WHOLE = ("tinyint", "smallint", "int", "bigint")

Pairs = Sequence[tuple[str, str]]


@dataclass(frozen=True)
class Skew:
    buckets: list[int]
    salts: int


def _kinds(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys' types. A frame analyses itself once for its schema, however many keys are asked for."""
    schema = df.schema
    names = set(schema.names)
    nested = [k for k in keys if k not in names]
    found = dict(zip(nested, (f.dataType.simpleString() for f in df.select(*nested).schema))) if nested else {}
    return [found[k] if k in found else schema[k].dataType.simpleString() for k in keys]


def _bucket(keys: Sequence[str], types: Sequence[str]) -> Column:
    """The bucket of a row's key, each part hashed as its type in ``types``: equal keys must fall in one bucket whatever
    their own types, so whole numbers are hashed as long."""
    wide = ["bigint" if t in WHOLE else t for t in types]
    return F.pmod(F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, wide)]), F.lit(BUCKETS)).cast("int")


def _common(spark: SparkSession, kinds: Sequence[str]) -> str:
    """The type in which values of these types are compared. Raises AnalysisException where there is none."""
    if len(set(kinds)) == 1:
        return kinds[0]
    return spark.range(0).select(F.coalesce(*[F.lit(None).cast(k) for k in kinds])).schema[0].dataType.simpleString()


def common_types(left: DataFrame, right: DataFrame, pairs: Pairs) -> list[str]:
    """The type in which each pair of keys is compared. Raises AnalysisException where there is none."""
    kinds = zip(_kinds(left, [l for l, _ in pairs]), _kinds(right, [r for _, r in pairs]))
    return [_common(left.sparkSession, k) for k in kinds]


def find_skews(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> list[Skew | None]:
    """For each set of key columns the overfull buckets of ``df``, or None.

    One pass over the key columns; brings at most BUCKETS counts per set to the driver.
    """
    spark = df.sparkSession
    if input_bytes(df) < setting(spark, SKEW_MIN_BYTES):
        return [None] * len(key_sets)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _bucket(keys, _kinds(df, keys)).alias("bucket")) for i, keys in enumerate(key_sets)])
    counts = df.select(F.inline(pairs)).groupBy("i", "bucket").count().collect()
    total = sum(r["count"] for r in counts if r["i"] == 0)
    share = max(total // int(spark.conf.get("spark.sql.shuffle.partitions")), setting(spark, SKEW_MIN_ROWS), 1)
    limit = max(2 * share, 8 * total // BUCKETS)
    found: list[Skew | None] = []
    for i in range(len(key_sets)):
        hot = {r["bucket"]: r["count"] for r in counts if r["i"] == i and r["count"] > limit}
        found.append(Skew(sorted(hot), -(-max(hot.values()) // share)) if hot else None)
    return found


def find_skew(df: DataFrame, keys: Sequence[str]) -> Skew | None:
    return find_skews(df, [keys])[0]


def _salted(left: DataFrame, keys: Sequence[str], types: Sequence[str], skew: Skew, copies: bool) -> DataFrame:
    """Salt the rows of overfull buckets by their content and, if there may be copies, by the task that reads them.

    Both stay the same when a task is repeated, unlike a random number or a row's position.
    """
    origin = [F.spark_partition_id()] if copies else []
    row_salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], *origin), F.lit(skew.salts))
    hot = _bucket(keys, types).isin(skew.buckets)
    return left.withColumn(SALT, F.when(hot, row_salt).otherwise(0).cast("int"))


def _repeated(right: DataFrame, keys: Sequence[str], types: Sequence[str], skew: Skew, name: str) -> DataFrame:
    every = F.sequence(F.lit(0), F.lit(skew.salts - 1))
    hot = _bucket(keys, types).isin(skew.buckets)
    return right.withColumn(name, F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))


def _key_types(spark: SparkSession, sides: Sequence[Sequence[str]]) -> list[str]:
    """For each key the type in which all sides can be compared; whole numbers as long."""
    types = [reduce(lambda a, b: _common(spark, [a, b]), kinds) for kinds in zip(*sides)]
    return ["bigint" if t in WHOLE else t for t in types]


def spread_join(
    left: DataFrame,
    rights: DataFrame | Sequence[DataFrame],
    on: Pairs,
    how: str = "inner",
    *,
    null_safe: bool = False,
    small: bool | None = None,
    skew: Skew | str | None = MEASURE,
    copies: bool = True,
) -> DataFrame:
    """Join ``left`` to one or more right sides on the same keys, keeping each right side's other columns.

    ``how`` is inner, left, left_semi or left_anti. ``small`` states a size check already made by the caller;
    without it the optimizer's estimate decides, for frames without a generator. ``skew=None`` states that no left key is
    hot, ``copies=False`` that no two left rows are equal; then later filters still reach the left side's scan.
    All right sides share one salting, so ``left`` is shuffled once however many there are.
    """
    rights = [rights] if isinstance(rights, DataFrame) else list(rights)
    is_small = [estimated_small(r) if small is None else small for r in rights]
    left_keys = [l for l, _ in on]
    left_columns = set(left.columns)
    if all(is_small):
        skew = None
    elif skew == MEASURE:
        skew = find_skew(left, left_keys)
    result = left
    own, others = _kinds(left, left_keys), [_kinds(r, [k for _, k in on]) for r in rights]
    types = _key_types(left.sparkSession, [own, *others])
    if skew:
        if types != _key_types(left.sparkSession, [own]):
            # The buckets were counted in the left side's own types: count them in those of the comparison.
            as_compared = left.select(*[F.col(k).cast(t).alias(f"k{j}") for j, (k, t) in enumerate(zip(left_keys, types))])
            skew = find_skew(as_compared, as_compared.columns)
        result = _salted(left, left_keys, types, skew, copies) if skew else left
    for i, (right, tiny, kinds) in enumerate(zip(rights, is_small, others)):
        names = {r: f"__r{i}_{r}" for _, r in on if r in left_columns}
        right = right.withColumnsRenamed(names) if names else right
        pairs = [(l, names.get(r, r)) for l, r in on]
        sides = [
            (F.col(l), F.col(r)) if kind == other else (F.col(l).cast(t), F.col(r).cast(t))
            for (l, r), t, kind, other in zip(pairs, types, own, kinds)
        ]
        terms = [l.eqNullSafe(r) if null_safe else l == r for l, r in sides]
        extra = [r for _, r in pairs]
        if tiny:
            right = F.broadcast(right)
        else:
            exploded = multiplies(right) or (how == "inner" and multiplies(left))
            if skew:
                salt = f"{SALT}{i}"
                right = _repeated(right, extra, types, skew, salt)
                terms.append(F.col(SALT) == F.col(salt))
                extra.append(salt)
            if exploded:
                # An adaptive plan would trust its own estimate and bring the exploded rows to the driver.
                right = right.hint("merge")
        result = result.join(right, reduce(lambda x, y: x & y, terms), how)
        if how in ("inner", "left"):
            result = result.drop(*extra)
    return result.drop(SALT) if skew else result


def reduce_to(few: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """The rows of ``other`` that belong to a small increment ``few``, by a broadcast of its keys: no shuffle."""
    return spread_join(other, few.select(key).distinct(), [(other_key, key)], "left_semi", small=True)


def merge_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on one key where a null key matches a null key."""
    return spread_join(left, right, [(key, key)], null_safe=True, small=measured_small(right))


def spine_cross(df: DataFrame, start: Column, end: Column, name: str = "day") -> DataFrame:
    """Each row once per day of the range, as a generator inside the task (no join, no shuffle)."""
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return df.withColumn(name, F.explode(F.when(start <= end, days)))


def new_rows(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], skew: Skew | str | None = MEASURE
) -> DataFrame:
    """Source rows whose key is not in the target. A null key part never matches, so such rows are kept.

    Null-keyed rows skip the join: hashed together they would be one hot group. ``skew=None`` states that no source
    key is hot, not even a null one; then the source is read once.
    """
    known = tgt.select(*keys)
    pairs = [(k, k) for k in keys]
    if skew is None:
        return spread_join(src, known, pairs, "left_anti", skew=None)
    missing = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    fresh = spread_join(src.filter(~missing), known, pairs, "left_anti", skew=skew)
    return fresh.unionByName(src.filter(missing))
