"""Writing folders, tables and views."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import identifier


def write_folders(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet below ``key=value`` folders.

    The rebalance hint lets Spark split a folder that holds much of the table over several tasks
    and join small ones, so no task writes a hot folder alone and few small files appear.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "errorifexists",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
) -> DataFrame:
    """Save as a Parquet table and return it; ``overwrite`` replaces the schema as well."""
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment is not None:
        spark.sql("COMMENT ON TABLE IDENTIFIER(:name) IS '" + comment.replace("'", "\\'") + "'", args={"name": name})
    return spark.table(name)


def append_with_new_columns(df: DataFrame, path: str) -> DataFrame:
    """Append rows that may have more or fewer columns than the folder; read back with all columns."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", True).parquet(path)


def load_if_empty(target: DataFrame, load: Callable[[], None]) -> bool:
    """Run ``load`` when the target has no rows; tells whether it ran."""
    if not target.isEmpty():
        return False
    load()
    return True


def quoted(text: str) -> str:
    """A text as SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_table_as(spark: SparkSession, name: str, path: str, select: str, **frames: DataFrame) -> DataFrame:
    """``CREATE TABLE … AS SELECT`` as Parquet at ``path``."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {quoted(path)} AS {select}", **frames)
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def commented_view(spark: SparkSession, name: str, comment: str, select: str) -> DataFrame:
    """A view with a comment over registered names."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} COMMENT {quoted(comment)} AS {select}")
    return spark.table(name)


def refresh(name: str, build: Callable[[], DataFrame], path: str | None = None) -> DataFrame:
    """Recompute a table in full and replace its content."""
    return save_table(build(), name, "overwrite", path)


def read_flagged(spark: SparkSession, path: str, rows: T.StructType, name: str) -> DataFrame:
    """Rows stored in folders by a flag; folder names are text, the schema makes them boolean again."""
    schema = T.StructType([f for f in rows if f.name != name] + [T.StructField(name, T.BooleanType())])
    return spark.read.schema(schema).parquet(path)


def write_flagged(df: DataFrame, path: str, name: str, flag: Column) -> DataFrame:
    """Parquet in two folders by a computed flag; filters on the flag read one folder."""
    write_folders(df.withColumn(name, flag), path, [name])
    return read_flagged(df.sparkSession, path, df.schema, name)


def rewrite_sorted(df: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """The rows range-sorted into a new folder; never into the one they come from."""
    df.orderBy(*order).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fan_out(df: DataFrame, column: str, path: str, folder: str = "part_of") -> DataFrame:
    """One folder per distinct value, named by its identifier form, in a single pass over the rows.

    Folder names are text and come back as text. Values with one identifier form share a folder.
    """
    named = df.withColumn(folder, identifier(F.col(column)))
    write_folders(named, path, [folder])
    schema = T.StructType([f for f in named.schema if f.name != folder] + [T.StructField(folder, T.StringType())])
    return df.sparkSession.read.schema(schema).parquet(path)
