"""Filters that bring another table or a scalar into play."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Audit columns that take no part in comparisons.
AUDIT_COLUMNS = ("_rescued_data", "FilePath", "FileModificationTime", "LoadTimestamp")


def without_audit_columns(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The frame without audit columns and further named ones; absent names do not matter."""
    return df.drop(*AUDIT_COLUMNS, *exclude)


def rows_in(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """``column IN (SELECT other_column FROM other)``."""
    wanted = other.select(F.col(other_column or column).alias("_wanted"))
    return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")


def rows_not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def newest_of_group(df: DataFrame, group: str, value: object, day: str) -> DataFrame:
    """Rows of one group that carry the group's newest day."""
    mine = df.filter(F.col(group) == F.lit(value))
    return mine.filter(F.col(day) == mine.agg(F.max(day)).scalar())


def parameterised(
    spark: SparkSession, text: str, arguments: Mapping[str, object], **frames: DataFrame
) -> DataFrame:
    """SQL text with named ``:arguments`` and frames named in braces; nothing is pasted into the text."""
    return spark.sql(text, args=dict(arguments), **frames)


def with_audit_columns(
    df: DataFrame,
    load_id: str,
    load_time: str,
    source_system: str,
    pipeline: str,
    run_as: str,
) -> DataFrame:
    """Constant load columns; clock and user are arguments, so a second run gives the same rows."""
    return df.withColumns(
        {
            "load_timestamp": F.lit(load_time),
            "load_id": F.lit(load_id),
            "source_system": F.lit(source_system),
            "pipeline_name": F.lit(pipeline),
            "run_as": F.lit(run_as),
        }
    )
