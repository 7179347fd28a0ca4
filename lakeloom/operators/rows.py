"""Row-level operators shared by the jobs."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark keeps the best ``n`` rows of a key in every task before it shuffles (window group limit),
    so a key that owns much of the table sends only ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def running_id(
    df: DataFrame,
    bucket: str,
    order: Sequence[str],
    name: str = "id",
    start: int = 1,
    within: Sequence[str] = (),
) -> DataFrame:
    """Number the rows without a gap, by ``bucket`` and then ``order``, anew in each ``within`` group."""
    first = running_offset(df, bucket, order, F.lit(1), name, within)
    return first.withColumn(name, F.col(name) + F.lit(start))


def running_offset(
    df: DataFrame,
    bucket: str,
    order: Sequence[str],
    weight: Column,
    name: str = "offset",
    within: Sequence[str] = (),
) -> DataFrame:
    """The sum of the weights of all rows before a row, by ``bucket`` and then ``order``.

    Rows are summed inside their bucket; only the bucket totals, one small row each, meet in one
    task. Pick buckets that no large share of the rows can fall into.
    """
    # One struct as key: NULL parts match, and window and join share one shuffle.
    grouped = df.withColumn("_weight", weight).withColumn("_group", F.struct(*within, bucket))
    totals = grouped.groupBy("_group").agg(F.sum("_weight").alias("_total"))
    parts = [F.col(f"_group.`{w}`") for w in within]
    before = (
        Window.partitionBy(*parts)
        .orderBy(F.col(f"_group.`{bucket}`"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        F.col("_group").alias("_same"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    ahead = (
        Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        grouped.withColumn("_ahead", F.coalesce(F.sum("_weight").over(ahead), F.lit(0)))
        .join(offsets, F.col("_group") == F.col("_same"))
        .withColumn(name, F.col("_offset") + F.col("_ahead"))
        .drop("_weight", "_group", "_same", "_offset", "_ahead")
    )


def copies(df: DataFrame, count: str, name: str, run: int = 1 << 16) -> DataFrame:
    """Each row as often as ``count`` says, numbered from 0 in ``name``; no array is longer than ``run`` or the
    number of runs."""
    n = F.col(f"`{count}`")
    runs = df.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / run))))
    size = F.least(F.lit(run).cast("bigint"), n - F.col("_run") * run)
    each = runs.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1)))
    return each.withColumn(name, F.col("_run") * run + F.col("_at")).drop("_run", "_at")


def as_number(df: DataFrame, name: str) -> Column:
    """An order-keeping double of a date, timestamp, number or boolean."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    raise ValueError(f"no number keeps the order of a {kind.simpleString()}")


def rank_among(name: str, bounds: Sequence[float] | None, repeated: bool = False) -> Column:
    """How many of the bounds the value of a column reaches, by binary search; 0 for NULL.

    Equal bounds count once, or each if ``repeated``: then few distinct values spread over all ranks, by their share of the rows.
    """
    given = sorted(bounds or [])
    marks = sorted(set(given))

    def search(low: int, high: int) -> str:
        if low == high:
            return str(bisect_left(given, marks[low]) if repeated and low < len(marks) else len(given) if repeated else low)
        middle = (low + high) // 2
        above, below = search(middle + 1, high), search(low, middle)
        return f"CASE WHEN {name} >= {marks[middle]!r}D THEN {above} ELSE {below} END"

    return F.expr(search(0, len(marks)))


def union_all_by_name(frames: Sequence[DataFrame], empty: DataFrame | None = None) -> DataFrame:
    """Union by name, missing columns NULL; ``empty`` gives the schema when the list is empty."""
    if not frames:
        if empty is None:
            raise ValueError("no frames and no empty frame given")
        return empty.limit(0)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all frames without duplicate rows: one shuffle at the end."""
    return reduce(DataFrame.union, frames).distinct()


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; those the frame lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def cast_ntz_to_timestamp(df: DataFrame) -> DataFrame:
    """Every zone-free timestamp column as a timestamp of the session zone."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def equals_global_max(df: DataFrame, column: str, equal: bool = True) -> DataFrame:
    """Rows whose column equals (or differs from) its largest value."""
    same = F.col(column) == df.agg(F.max(column)).scalar()
    return df.filter(same if equal else ~same)


def all_but_last(df: DataFrame, key: str) -> DataFrame:
    """All rows but the one with the largest (unique) key."""
    return equals_global_max(df, key, equal=False)


def summary_rows(df: DataFrame) -> DataFrame:
    """One row per column: count, mean, sample deviation, smallest and largest value, and the table size.

    A single aggregation over the table; mean and deviation are NULL for columns that are no numbers.
    """
    aggregates, entries = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, T.NumericType)
        aggregates += [
            F.count(c).alias(f"_count{i}"),
            (F.avg(c) if numeric else F.lit(None)).cast("double").alias(f"_mean{i}"),
            (F.stddev(c) if numeric else F.lit(None)).cast("double").alias(f"_stddev{i}"),
            F.min(c).cast("string").alias(f"_min{i}"),
            F.max(c).cast("string").alias(f"_max{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"_count{i}").alias("count"),
                F.col(f"_mean{i}").alias("mean"),
                F.col(f"_stddev{i}").alias("stddev"),
                F.col(f"_min{i}").alias("min"),
                F.col(f"_max{i}").alias("max"),
                F.col("_rows").alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))
