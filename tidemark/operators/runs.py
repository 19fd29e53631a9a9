"""Rows of days as runs: equal rows on days at even steps, one row with the first and the last day.

A grid of days changes by whole stretches, so what is compared, joined and updated are runs, some hundred times fewer.
Days come back where rows are written, by a generator inside the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import month_number
from tidemark.operators.loads import upsert
from tidemark.operators.rows import row_hash
from tidemark.session import stage

FIRST, LAST, PHASE = "__first", "__last", "__phase"
#: Bits of a day's hash that are summed: sums stay exact for up to 2^23 days.
MASK = (1 << 40) - 1


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _phase(day: Column, period: int) -> Column:
    """Days of one phase are whole periods apart."""
    return F.pmod(F.unix_date(day), F.lit(period)).alias(PHASE)


def _marked(day: Column) -> Column:
    return F.xxhash64(day).bitwiseAND(F.lit(MASK))


def _days(first: Column, last: Column, period: int) -> Column:
    return F.sequence(first, last, F.expr(f"interval {period} days"))


def days_of(period: int) -> Column:
    """The days of a run, one row each."""
    return F.explode(_days(F.col(FIRST), F.col(LAST), period))


def to_runs(df: DataFrame, day: str, period: int, folder: str | None = None) -> DataFrame:
    """``df`` as runs: its columns without ``day``, and FIRST and LAST. Copies of a row are runs of their own.

    Rows are grouped by all other columns, combined within the tasks. Most groups are one run: as many days as there are
    periods from the first to the last, and the days' hashes add up to those of all of these. Only the rows of other
    groups are sorted. A row without a day has no run.
    """
    others = [c for c in df.columns if c != day]
    rows = df.filter(F.col(day).isNotNull()).withColumn(PHASE, _phase(F.col(day), period))
    facts = [F.min(day).alias(FIRST), F.max(day).alias(LAST), F.count("*").alias("__n"), F.sum(_marked(F.col(day))).alias("__sum")]
    groups = stage(rows.groupBy(*_quoted(others), PHASE).agg(*facts), folder)
    spanned = F.datediff(LAST, FIRST) / period + 1 == F.col("__n")
    every = F.aggregate(_days(F.col(FIRST), F.col(LAST), period), F.lit(0).cast("long"), lambda s, d: s + _marked(d))
    whole = F.when(spanned, every == F.col("__sum")).otherwise(False)
    regular = groups.filter(whole).select(*_quoted(others), FIRST, LAST)
    broken = groups.filter(~whole)
    if broken.isEmpty():
        return regular
    names = [*others, PHASE]
    side = broken.select(*[F.col(f"`{c}`").alias(f"__b{i}") for i, c in enumerate(names)])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__b{i}")) for i, c in enumerate(names)])
    rest = rows.join(side, same, "left_semi")
    copy = F.row_number().over(Window.partitionBy(*_quoted(names), day).orderBy(day)).alias("__copy")
    numbered = rest.select(*_quoted(names), day, copy)
    place = F.row_number().over(Window.partitionBy(*_quoted(names), "__copy").orderBy(day))
    island = F.date_sub(F.col(day), (place * period).cast("int")).alias("__island")
    islands = numbered.select(*_quoted(names), day, "__copy", island)
    found = islands.groupBy(*_quoted(names), "__copy", "__island").agg(F.min(day).alias(FIRST), F.max(day).alias(LAST))
    return regular.unionByName(found.select(*_quoted(others), FIRST, LAST))


def to_days(runs: DataFrame, day: str, period: int, columns: Sequence[str]) -> DataFrame:
    """The rows of the runs, one a day, with ``columns`` in this order. Runs are few: they are dealt out evenly first."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = runs.repartition(parts).withColumn(day, days_of(period))
    return spread.select(*_quoted(columns))


def by_month(runs: DataFrame, period: int) -> DataFrame:
    """The runs cut where a month ends: each row's days are of one month, the one of FIRST."""
    others = [c for c in runs.columns if c not in (FIRST, LAST)]
    starts = F.sequence(F.trunc(F.col(FIRST), "month"), F.trunc(F.col(LAST), "month"), F.expr("interval 1 month"))
    cut = runs.select("*", F.explode(starts).alias("__start"))
    skipped = F.greatest(F.lit(0), F.ceil(F.datediff("__start", FIRST) / period))
    kept = F.floor(F.datediff(F.least(F.col(LAST), F.last_day("__start")), FIRST) / period)
    ends = [F.date_add(FIRST, (n * period).cast("int")).alias(name) for n, name in ((skipped, FIRST), (kept, LAST))]
    return cut.select(*_quoted(others), *ends).filter(F.col(FIRST) <= F.col(LAST))


def touched_months(src: DataFrame, tgt: DataFrame, keys: Sequence[str], period: int) -> DataFrame:
    """``loads.touched_months`` of the runs' days, without ``most``; ``keys`` without the day.

    Runs cut alike have the same days or none in common, so they are compared as the days would be one by one.
    """
    columns = [c for c in src.columns if c not in (FIRST, LAST)]
    cut = cut_alike([src, tgt.select(*_quoted(src.columns))], keys, period)

    def narrow(df: DataFrame, is_source: bool) -> DataFrame:
        hashes = [row_hash(columns, seed).alias(f"__h{seed}") for seed in (1, 2)]
        return df.select(*_quoted(keys), FIRST, LAST, *hashes, F.lit(int(is_source)).alias("__s"))

    ends = [f(h).alias(f"{name}{h[-1]}") for h in ("__h1", "__h2") for f, name in ((F.min, "lo"), (F.max, "hi"))]
    per_key = narrow(cut[0], True).unionByName(narrow(cut[1], False)).groupBy(*_quoted(keys), FIRST, LAST)
    per_key = per_key.agg(*ends, F.count(F.lit(1)).alias("rows"), F.sum("__s").alias("sources"))
    keyless = reduce(lambda x, y: x | y, [k.isNull() for k in _quoted(keys)])
    targets = F.col("rows") - F.col("sources")
    differs = (F.col("lo1") != F.col("hi1")) | (F.col("lo2") != F.col("hi2"))
    touched = (F.col("sources") > 0) & (keyless | (targets == 0) | differs)
    days = _days(F.col(FIRST), F.col(LAST), period)
    months = F.array_distinct(F.transform(days, month_number))
    matched = F.when((F.col("sources") > 0) & ~keyless, targets * F.size(days)).otherwise(0)
    spread = per_key.select(matched.alias("matched"), F.posexplode_outer(F.when(touched, months)).alias("n", "month"))
    once = F.when(F.coalesce("n", F.lit(0)) == 0, F.col("matched")).otherwise(0)
    return spread.groupBy("month").agg(F.sum(once).alias("matched"))


def cut_alike(sides: Sequence[DataFrame], keys: Sequence[str], period: int) -> list[DataFrame]:
    """The runs of both sides cut wherever a run with the same keys and phase begins or has ended on either side.

    After that two runs of a key either have the same days or none in common, so FIRST stands for all days.
    """
    phased = [s.withColumn(PHASE, _phase(F.col(FIRST), period)) for s in sides]
    ends = F.array(F.col(FIRST), F.date_add(LAST, period))
    names = [*keys, PHASE]
    points = reduce(DataFrame.unionByName, [p.select(*_quoted(names), F.explode(ends).alias("__at")) for p in phased])
    # At most two points a run of the key.
    points = points.groupBy(*_quoted(names)).agg(F.array_sort(F.collect_set("__at")).alias("__points"))
    points = points.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(names)], "__points")
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(names)])
    out = []
    for side, own in zip(sides, phased):
        begin = F.filter("__points", lambda p: (p >= F.col(FIRST)) & (p <= F.col(LAST)))
        stop = F.filter("__points", lambda p: (p > F.col(FIRST)) & (p <= F.date_add(LAST, period)))
        pieces = F.inline(F.arrays_zip(begin.alias("begin"), stop.alias("stop")))
        others = [c for c in side.columns if c not in (FIRST, LAST)]
        cut = own.join(points, same).select(*_quoted(others), pieces)
        out.append(cut.select(*_quoted(others), F.col("begin").alias(FIRST), F.date_sub("stop", period).alias(LAST)))
    return out


def upsert_runs(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], update: Sequence[str], period: int, order: Sequence[str] = (), folder: str | None = None
) -> DataFrame:
    """``upsert`` of runs: ``keys`` without the day. Equal to the upsert of their days, source rows being distinct."""
    src, tgt = cut_alike([src, tgt.select(*_quoted(src.columns))], keys, period)
    return upsert(src, tgt, [*keys, FIRST], update, order, folder=folder)


def upsert_days(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    day: str,
    period: int,
    order: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """The same as ``upsert`` of rows of days with the key ``keys``, ``day`` among them, by way of runs.

    Rows without a day match nothing: the target's stay, the source's come in.
    """
    columns = tgt.columns
    src = src.select(*_quoted(columns)).distinct()
    runs = [to_runs(df, day, period, folder) for df in (src, tgt)]
    changed = upsert_runs(*runs, [k for k in keys if k != day], update, period, order, folder)
    undated = [df.filter(F.col(day).isNull()) for df in (tgt, src)]
    return reduce(DataFrame.unionByName, [to_days(changed, day, period, columns), *undated])
