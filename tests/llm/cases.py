"""Rows that are hard on operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `_score` double, `_m` string, `_digest` int, `fp` int, `_row` int, `_rank` int, words string"


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [
        (1, line * 3), (2, line * 3), (2, line * 3), (3, ""), (4, None), (5, " \t\n "), (None, line), (None, None), (6, "one"),
        (7, "x" * 300_000), (8, "word " * 60_000), (9, "a b c d e f"), (10, "é你好 \U0001f600 \x00 \x1c \x85 end"), (11, None),
    ]
    return spark.createDataFrame([(i, t, None, None, None, 0.5, None, None, None, 1, 2, None, "w") for i, t in texts], DOCS)


def labels(spark: SparkSession, rows=((1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (1, 1, 0))) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def no_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
