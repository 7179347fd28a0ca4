"""Registration of queries, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import scratch

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_NAMED = re.compile(r"\{(" + "|".join(TABLES) + r")\}")


class Tables:
    """The test tables of one folder; reading an attribute gives the DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def sql(self, text: str) -> DataFrame:
        """Run a text that names tables as ``{orders}``; the same text feeds the SQL counterpart."""
        used = {name: getattr(self, name) for name in set(_NAMED.findall(text))}
        quoted = text.replace("{", "{{").replace("}", "}}")
        for name in used:
            quoted = quoted.replace("{{" + name + "}}", "{" + name + "}")
        return self.spark.sql(quoted, **used) if used else self.spark.sql(text)

    def scratch(self, name: str) -> str:
        return scratch(self.spark, name)


def plain(text: str) -> str:
    """The text with ``{orders}`` turned to ``orders``."""
    return _NAMED.sub(r"\1", text)


def without_zone(df: DataFrame) -> DataFrame:
    """Results carry zone-free timestamps, as the Parquet inputs do."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema):
        return df
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(key: str, sql: str | None = None):
    """Register a function from :class:`Tables` to a DataFrame under ``key``."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: without_zone(build(Tables(spark, folder)))
        if sql is not None:
            ORACLE[key] = plain(sql)
        return build

    return register
