"""Data-quality rules: warn, drop, fail, count check, missing rows, key uniqueness, quarantine.

A rule that gives NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, Column | str]


class Checked(NamedTuple):
    """The rows after the rules, and one row of counts per rule."""

    rows: DataFrame
    metrics: DataFrame


def holds(rule: Column | str) -> Column:
    """Whether a rule, a column or SQL text, is true."""
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def all_hold(rules: Rules) -> Column:
    return reduce(Column.__and__, [holds(r) for r in rules.values()])


def _counts(rules: Rules) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(holds(r)).alias(f"_r{i}") for i, r in enumerate(rules.values())],
    ]


def metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """``rule, passed, failed`` for all rules in one pass."""
    counts = df.agg(*_counts(rules))
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"_r{i}").alias("passed"),
            (F.col("_all") - F.col(f"_r{i}")).alias("failed"),
        )
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _kept(df: DataFrame, rules: Rules, action: str) -> DataFrame:
    if action == "warn":
        return df
    if action == "drop":
        return df.filter(all_hold(rules))
    if action == "fail":
        broken = F.concat_ws(
            ", ", *[F.when(~holds(r), F.lit(name)) for name, r in rules.items()]
        )
        return df.filter(
            F.when(all_hold(rules), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("expectation failed: "), broken)).cast("boolean")
            )
        )
    raise ValueError("action is 'warn', 'drop' or 'fail'")


def expect(df: DataFrame, rules: Rules, action: str = "warn") -> Checked:
    """``warn`` keeps all rows, ``drop`` removes failing ones, ``fail`` stops the job at the first one.

    Failing happens in the tasks that read the rows: no extra pass, and no row gets through.
    """
    return Checked(_kept(df, rules, action), metrics(df, rules))


class Watched(NamedTuple):
    """The rows after the rules, and what to ask for the counts once the rows have been used."""

    rows: DataFrame
    counts: Callable[[], list[tuple[str, int, int]]]


def watch(df: DataFrame, rules: Rules, action: str = "warn") -> Watched:
    """As :func:`expect`, with the counts taken while the rows pass by: a single read does both.

    ``counts()`` gives ``(rule, passed, failed)`` and waits for the first action on the rows.
    """
    seen = Observation()
    rows = _kept(df.observe(seen, *_counts(rules)), rules, action)

    def counts() -> list[tuple[str, int, int]]:
        found = seen.get
        total = found.get("_all", 0)
        passed = [found.get(f"_r{i}", 0) for i in range(len(rules))]
        return [(name, n, total - n) for name, n in zip(rules, passed)]

    return Watched(rows, counts)


def count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both row counts side by side and whether they agree."""
    rows = F.count(F.lit(1))
    counts = source.agg(rows.alias("source_count")).withColumn(
        "target_count", target.agg(rows).scalar()
    )
    return counts.withColumn("no_rows_dropped", F.col("source_count") == F.col("target_count"))


def missing_records(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """All source rows with the key found in the target, NULL where it is missing."""
    found = target.select(F.col(key).alias("target_key"))
    return source.join(found, F.col(key) == F.col("target_key"), "left")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key and whether the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_entries")).withColumn(
        "unique_pk", F.col("num_entries") == 1
    )


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """All rows with ``is_quarantined``: true unless every rule holds."""
    return df.withColumn("is_quarantined", ~all_hold(rules))


def valid(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_quarantined"))


def invalid(flagged: DataFrame) -> DataFrame:
    return flagged.filter("is_quarantined")
