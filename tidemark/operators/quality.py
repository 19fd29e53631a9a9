"""Rules a target table puts on its rows, and what to do with rows that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import spread_join


class RuleViolation(ValueError):
    """Rows break the rules of their target; ``counts`` says how many rows break which rule."""

    def __init__(self, counts: Mapping[str, int]):
        super().__init__(", ".join(f"{rule}: {n} rows" for rule, n in counts.items()))
        self.counts = dict(counts)


@dataclass(frozen=True)
class Rules:
    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    unique: Sequence[str] = ()

    def checks(self) -> dict[str, Column]:
        """Row rules: name → condition under which a row breaks it."""
        broken = {f"{c} is null": F.col(c).isNull() for c in self.not_null}
        for c, n in self.max_length.items():
            broken[f"{c} is longer than {n}"] = F.coalesce(F.length(c) > n, F.lit(False))
        return broken


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in one of the columns."""
    return df.filter(_any(list(Rules(not_null=columns).checks().values())))


def max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than allowed."""
    return df.filter(_any(list(Rules(max_length=limits).checks().values())))


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def taken(df: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``df`` that the target already holds. As in a UNIQUE constraint, a null equals a null."""
    return spread_join(
        tgt.select(*keys), df.select(*keys).distinct(), [(k, k) for k in keys], "left_semi", null_safe=True
    )


def violations(df: DataFrame, rules: Rules) -> dict[str, int]:
    """Rows per broken rule: one scan for all row rules, one grouped pass for uniqueness."""
    checks = rules.checks()
    found = {}
    if checks:
        counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, broken in enumerate(checks.values())]).first()
        found = {rule: n for rule, n in zip(checks, counts) if n}
    return found | repeats(df, rules)


def repeats(df: DataFrame, rules: Rules) -> dict[str, int]:
    """Rows that break the rule of uniqueness, if there is one."""
    if not rules.unique:
        return {}
    n = unique(df, rules.unique).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {f"{', '.join(rules.unique)} is repeated": n} if n else {}


def mark(df: DataFrame, rules: Rules) -> DataFrame:
    """Add ``reason``: the broken rules of each row, empty for a good row. All rows of a repeated key are broken."""
    reasons = [F.when(broken, F.lit(rule)) for rule, broken in rules.checks().items()]
    columns = df.columns
    if rules.unique:
        keys = list(rules.unique)
        repeated = unique(df, keys).select(*keys, F.lit(True).alias("__repeated"))
        df = spread_join(df, repeated, [(k, k) for k in keys], "left")
        reasons.append(F.when(F.col("__repeated"), F.lit(f"{', '.join(keys)} is repeated")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return df.select(*[F.col(f"`{c}`") for c in columns], reason.alias("reason"))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their ``reason``."""
    marked = mark(df, rules)
    return marked.filter("reason = ''").drop("reason"), marked.filter("reason <> ''")


def enforce(df: DataFrame, rules: Rules, mode: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """``fail``: one broken rule rejects the whole load. ``quarantine``: split off the broken rows."""
    if mode == "quarantine":
        return split(df, rules)
    found = violations(df, rules)
    if found:
        raise RuleViolation(found)
    return df, None
