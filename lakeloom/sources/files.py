"""Reading files, folders, tables and file listings."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """Files of any format Spark knows, by folder, list or wildcard.

    Options are Spark's own: ``header``, ``inferSchema``, ``multiLine``, ``basePath``, ``mergeSchema``.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text without options: text columns ``_c0``, ``_c1``, …"""
    return read_files(spark, path, "csv")


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Delimited text with a header; types are inferred by a pass over the files unless given."""
    if schema is not None:
        return read_files(spark, path, "csv", schema, header=True)
    return read_files(spark, path, "csv", header=True, inferSchema=True)


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that hold one JSON document each, over several lines."""
    return read_files(spark, path, "json", schema, multiLine=True)


def captured_messages(spark: SparkSession, path: str, fmt: str = "avro") -> DataFrame:
    """Message captures below a deep wildcard; the Avro reader must be on the class path."""
    return read_files(spark, path, fmt)


def one_partition(spark: SparkSession, root: str, **values: object) -> DataFrame:
    """One folder ``key=value/…`` below ``root`` without its partition columns."""
    folder = "/".join([root, *[f"{k}={v}" for k, v in values.items()]])
    return read_files(spark, folder, basePath=folder)


def file_listing(
    spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Path, name, size and time of files; only the listing is read, never the content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def sql_on_files(spark: SparkSession, query: str, path: str, fmt: str, **options: object) -> DataFrame:
    """SQL straight over a file path: ``{files}`` in the text stands for the rows of the files.

    Path, format and options are part of a statement of its own; its name is used once and gone when the plan is made.
    """
    name = f"files_{uuid4().hex[:12]}"
    given = ", ".join(f"{quoted(k)} {quoted(v)}" for k, v in {"path": path, **options}.items())
    spark.sql(f"CREATE TEMPORARY VIEW {name} USING {fmt} OPTIONS ({given})")
    try:
        return spark.sql(query.replace("{files}", name))
    finally:
        spark.catalog.dropTempView(name)


def quoted(value: object) -> str:
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scanned_files(df: DataFrame) -> DataFrame:
    """Path, name, size, time and number of rows of every file that a scan reads, grouped in its tasks."""
    meta = {"path": "file_path", "name": "file_name", "size": "file_size", "modified": "file_modification_time"}
    return df.groupBy(*[F.col(f"_metadata.{m}").alias(n) for n, m in meta.items()]).agg(F.count(F.lit(1)).alias("rows"))


def folder_sizes(listing: DataFrame) -> DataFrame:
    """Files and bytes per folder."""
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return listing.groupBy(folder).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def relative_to(root: Column, path: Column) -> Column:
    """The part of a path after its root."""
    return F.substring(path, F.length(root) + 1, F.length(path))


def manifest_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Status of every source file by relative ``file`` and ``size``: missing, same, resized, or skipped.

    Hidden and temporary files are skipped; files only the target has do not matter.
    """
    there = target.select(F.col("file").alias("_file"), F.col("size").alias("target_size"))
    name = F.substring_index("file", "/", -1)
    status = (
        F.when(name.startswith(".") | name.endswith(".tmp"), "skipped")
        .when(F.col("target_size").isNull(), "missing")
        .when(F.col("target_size") == F.col("size"), "same")
        .otherwise("resized")
    )
    return source.join(there, F.col("file") == F.col("_file"), "left").select(
        "file", "size", "target_size", status.alias("status")
    )
