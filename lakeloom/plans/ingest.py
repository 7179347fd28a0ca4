"""Enrichment of raw rows: file metadata, load columns, decoded body, hash key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import hash_key
from lakeloom.operators.filters import with_audit_columns

# Members of the file metadata column that become columns of their own.
METADATA = (
    "file_path", "file_name", "file_size", "file_block_start", "file_block_length",
    "file_modification_time",
)


def with_file_columns(df: DataFrame, prefix: str = "meta_") -> DataFrame:
    """The file metadata of a scan as plain columns."""
    meta = [F.col(f"_metadata.{m}").alias(prefix + m) for m in METADATA]
    return df.select("*", *meta)


def enrich(df: DataFrame, body: str, **load: str) -> DataFrame:
    """A scan with file columns, load columns, the body as text and a hash over body and text.

    ``load`` holds load_id, load_time, source_system, pipeline and run_as.
    """
    text = F.col(body).cast("string")
    return with_audit_columns(with_file_columns(df), **load).select(
        "*", text.alias("body_string"), hash_key(text, text).alias("hash_key")
    )


def decode_body(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The JSON in a text column as columns, by a declared schema; the text column goes."""
    return df.withColumn("_body", F.from_json(F.col(text), schema)).select("*", "_body.*").drop(
        "_body", text
    )


def first_of_list(df: DataFrame, column: str, members: tuple[str, ...]) -> DataFrame:
    """Members of the first entry of a list column as ``column_member``; NULL for an empty list."""
    entry = F.get(F.col(column), F.lit(0))
    return df.select("*", *[entry[m].alias(f"{column}_{m}") for m in members]).drop(column)
