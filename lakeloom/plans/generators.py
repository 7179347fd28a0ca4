"""Repeatable test data: customers, daily snapshots and increments, a comparison set.

Values are drawn from a digest of the row id, so every run and every partitioning gives the same
rows, and rows are made where their ids are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.rows import all_but_last

# Lists the customers are drawn from.
FIRST_NAMES = ("Anna", "Ben", "Carla", "David", "Elena", "Felix", "Gina", "Hugo", "Iris", "Jonas")
LAST_NAMES = ("Ammann", "Berger", "Conti", "Dubois", "Egli", "Favre", "Graf", "Huber", "Iseli", "Keller")
COUNTRIES = ("Austria", "France", "Germany", "Italy", "Liechtenstein", "Switzerland")
STREETS = ("Bahnhofstrasse", "Dorfstrasse", "Hauptstrasse", "Kirchgasse", "Seeweg")
RELIGIONS = ("none", "catholic", "reformed", "orthodox", "muslim", "jewish", "other")
EDUCATION = ("primary", "apprenticeship", "college", "university")
OCCUPATIONS = (
    "miller", "roofer", "surveyor", "optician", "forester", "beekeeper", "tailor", "geologist", "welder", "glazier",
    "translator", "archivist", "brewer", "potter", "mason", "printer", "tiler", "tanner", "sailor", "vintner",
)
MARITAL_STATUS = ("Single", "Married", "Divorced")
SEX = ("Male", "Female", "Not Sure")
HOBBIES = ("chess", "rowing", "knitting", "hiking", "choir", "astronomy")


def digest(row_id: Column, seed: int) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string")), 256)


def number(digest: Column, field: int, below: int) -> Column:
    """A number from 0 to ``below`` - 1 out of four hex digits of the digest."""
    digits = F.substring(digest, 4 * field + 1, 4)
    return (F.conv(digits, 16, 10).cast("int") % below).cast("int")


def pick(digest: Column, field: int, values: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number(digest, field, len(values)))


def uuid_of(digest: Column) -> Column:
    """The digest's first 32 digits in the form of a UUID."""
    return F.concat_ws(
        "-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )


def _birthday(digest: Column, field: int) -> Column:
    return F.date_sub(F.lit("2025-01-01").cast("date"), number(digest, field, 36525))


def fake_customers(ids: DataFrame, id_column: str, seed: int = 1) -> DataFrame:
    """One customer with 16 columns per id."""
    rows = ids.select(digest(F.col(id_column), seed).alias("_d"))
    d = F.col("_d")
    return rows.select(
        uuid_of(d).alias("primary_key"),
        pick(d, 0, FIRST_NAMES).alias("name"),
        pick(d, 1, LAST_NAMES).alias("surname"),
        _birthday(d, 2).alias("date_of_birth"),
        pick(d, 3, COUNTRIES).alias("nationality"),
        F.concat_ws(
            " ", pick(d, 4, STREETS), (number(d, 5, 200) + 1).cast("string")
        ).alias("address"),
        F.concat(F.lit("+41 "), F.lpad(number(d, 6, 10000).cast("string"), 4, "0")).alias("phone_number"),
        F.lower(
            F.concat(pick(d, 0, FIRST_NAMES), F.lit("."), pick(d, 1, LAST_NAMES), F.lit("@example.com"))
        ).alias("email"),
        pick(d, 7, RELIGIONS).alias("religion"),
        (number(d, 8, 82) + 18).alias("age"),
        pick(d, 9, EDUCATION).alias("education"),
        pick(d, 10, OCCUPATIONS).alias("occupation"),
        (number(d, 11, 90001) + 10000).alias("income"),
        pick(d, 12, MARITAL_STATUS).alias("marital_status"),
        pick(d, 13, SEX).alias("sex"),
        pick(d, 14, HOBBIES).alias("hobby"),
    )


def arrivals(ids: DataFrame, id_column: str, step_column: str, seed: int = 2) -> DataFrame:
    """Short customer rows (six columns) with the step, counted from 1, at which they arrive."""
    rows = ids.select(digest(F.col(id_column), seed).alias("_d"), F.col(step_column).alias("step"))
    d = F.col("_d")
    return rows.select(
        uuid_of(d).alias("primary_key"),
        pick(d, 0, FIRST_NAMES).alias("name"),
        pick(d, 1, LAST_NAMES).alias("surname"),
        _birthday(d, 2).alias("date_of_birth"),
        pick(d, 3, COUNTRIES).alias("country"),
        (number(d, 8, 82) + 18).cast("bigint").alias("age"),
        "step",
    )


# The scripted customers; the step of their update, and the step of their deletion.
SCRIPTED = (
    ("PK1", "Update1", "Update1", "1990-05-15", "Switzerland", 34, 2, None),
    ("PK2", "Delete1", "Delete1", "1985-08-20", "Switzerland", 38, None, 3),
    ("PK3", "Update2", "Update2", "1992-11-30", "Switzerland", 31, 4, None),
    ("PK4", "Delete2", "Delete2", "1995-07-25", "Switzerland", 28, None, 5),
    ("PK5", "Update3", "Update3", "1980-03-10", "Switzerland", 44, None, None),
)
UPDATED = "UPDATED"


def folder_columns(df: DataFrame, day: Column) -> DataFrame:
    """``Year``, ``Month`` and ``Day`` for date folders."""
    return df.withColumns({"Year": F.year(day), "Month": F.month(day), "Day": F.dayofmonth(day)})


def daily_increments(arriving: DataFrame, first_day: str) -> DataFrame:
    """Each row once, on the day of its step, with the folder columns."""
    day = F.date_add(F.lit(first_day).cast("date"), (F.col("step") - 1).cast("int"))
    return folder_columns(arriving, day).drop("step")


def daily_snapshots(arriving: DataFrame, days: int, first_day: str) -> DataFrame:
    """Full snapshots of ``days`` days in one frame: all rows that have arrived, and the scripted ones.

    Five scripted customers are there from step 1: PK1 and PK3 change at steps 2 and 4, PK2 and PK4
    leave at steps 3 and 5.
    """
    spark = arriving.sparkSession
    steps = F.explode(F.sequence(F.col("step").cast("int"), F.lit(days))).alias("_at")
    grown = arriving.filter(F.col("step") <= days).select(*[c for c in arriving.columns if c != "step"], steps)
    scripted = spark.createDataFrame(
        SCRIPTED,
        "primary_key string, name string, surname string, born string, country string, age bigint,"
        " changes int, leaves int",
    ).select(
        "*", F.explode(F.sequence(F.lit(1), F.least(F.coalesce(F.col("leaves") - 1, F.lit(days)), F.lit(days)))).alias("_at")
    )
    changed = F.col("_at") >= F.col("changes")
    scripted = scripted.select(
        "primary_key",
        F.when(changed, UPDATED).otherwise(F.col("name")).alias("name"),
        F.when(changed, UPDATED).otherwise(F.col("surname")).alias("surname"),
        F.col("born").cast("date").alias("date_of_birth"),
        "country",
        "age",
        "_at",
    )
    day = F.date_add(F.lit(first_day).cast("date"), F.col("_at") - 1)
    return folder_columns(grown.unionByName(scripted), day).withColumn("snapshot_date", day).drop("_at")


def four_schemas(
    customers: DataFrame, orders: DataFrame, products: DataFrame, order_items: DataFrame,
    customer_key: str, extra_product: DataFrame, customer_date: str,
) -> dict[str, dict[str, DataFrame]]:
    """Four sets of four entities with known differences.

    schema2 equals schema1; schema3 lacks the last customer and has one product more; schema4 holds a
    customer date as timestamp.
    """
    base = {"customers": customers, "orders": orders, "products": products, "order_items": order_items}
    fewer = all_but_last(customers, customer_key)
    return {
        "schema1": base,
        "schema2": dict(base),
        "schema3": {**base, "customers": fewer, "products": products.union(extra_product)},
        "schema4": {
            **base,
            "customers": customers.withColumn(customer_date, F.col(customer_date).cast("timestamp")),
        },
    }
