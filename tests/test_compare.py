import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import compare as C
from lakeloom.plans.generators import four_schemas
from tests.helpers import rows


def four(spark):
    ten = range(1, 11)
    make = spark.createDataFrame
    customers = make([(i, f"Customer {i}", f"customer{i}@example.com", dt.date(2023, 1, i % 28 + 1)) for i in ten],
                     "customer_id bigint, customer_name string, customer_email string, signup_date date")
    orders = make([(i, i, dt.date(2023, 2, i % 28 + 1), 100.0 + i) for i in ten],
                  "order_id bigint, customer_id bigint, order_date date, total_amount double")
    products = make([(i, f"Product {i}", "Category A", 10.0 + i) for i in ten],
                    "product_id bigint, product_name string, category string, price double")
    items = make([(i, i, i, 1, 10.0 + i) for i in ten],
                 "order_item_id bigint, order_id bigint, product_id bigint, quantity bigint, item_price double")
    extra = make([(11, "Product 11", "Category A", 21.0)], products.schema)
    return four_schemas(customers, orders, products, items, "customer_id", extra, "signup_date")


def test_four_schema_verdicts(spark):
    pairs = [("schema1", f"schema{i}") for i in (2, 3, 4)]
    got = {(r[1], r[2]): tuple(r[3:]) for r in C.compare_all(four(spark), pairs).collect()}
    equal = (True, 0, 0, True)
    assert all(got["schema2", e] == equal for e in ("customers", "orders", "products", "order_items"))
    assert got["schema3", "customers"] == (True, 1, 0, False)
    assert got["schema3", "products"] == (True, 0, 1, False)
    assert got["schema3", "orders"] == equal and got["schema3", "order_items"] == equal
    assert got["schema4", "customers"] == (False, None, None, False)
    assert all(got["schema4", e] == equal for e in ("orders", "products", "order_items"))


def test_order_does_not_matter(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    assert rows(C.compare(df, df.repartition(5).orderBy(F.col("x").desc()))) == []
    C.require_equal(df, df.orderBy(F.col("id").desc()))


def test_copies_count(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(C.compare(a, b)) == sorted([(1, "source", 2), (2, "source", 1), (3, "target", 1)], key=repr)
    with pytest.raises(AssertionError):
        C.require_equal(a, b)


def test_audit_and_excluded_columns_do_not_count(spark):
    a = spark.createDataFrame([(1, "f1", 5)], "x int, FilePath string, y int")
    b = spark.createDataFrame([(1, 6)], "x int, y int")
    assert len(rows(C.compare(a, b))) == 2
    assert rows(C.compare(a, b, exclude=["y"])) == []


def test_schema_diff(spark):
    a = spark.createDataFrame([], "x int, y string, z date")
    b = spark.createDataFrame([], "x bigint, y string, w int")
    assert {r[0]: r[3] for r in C.schema_diff(a, b).collect()} == {"x": "type", "y": "equal", "z": "missing", "w": "extra"}
    with pytest.raises(ValueError):
        C.compare(a, b)


def test_maps_are_compared_by_entries(spark):
    a = spark.sql("SELECT 1 AS k, map('a', 1, 'b', 2) AS m")
    b = spark.sql("SELECT 1 AS k, map('b', 2, 'a', 1) AS m")
    assert rows(C.compare(a, b)) == []


def keyed(spark, a, b, **kw):
    schema = "k int, name string, price double"
    return rows(C.compare_keyed(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), **kw))


def test_tolerance_with_and_without_keys(spark):
    a = [(1, "x", 100.0), (2, "y", 5.0), (3, "z", 0.0)]
    b = [(1, "x", 100.0005), (2, "y", 5.1), (3, "z", 1e-9)]
    assert keyed(spark, a, b, keys=["k"]) == [(2, "changed", "price")]
    assert keyed(spark, a, b) == [(2, "y", "changed", "price")]


def test_missing_extra_and_changed(spark):
    a = [(1, "x", 1.0), (2, "y", 2.0), (None, "n", 3.0)]
    b = [(2, "q", 2.0), (4, "w", 4.0), (None, "n", 3.0)]
    assert keyed(spark, a, b, keys=["k"]) == [(1, "missing", None), (2, "changed", "name"), (4, "extra", None)]


def test_copies_of_a_key_pair_in_order(spark):
    a = [(1, "x", float(i)) for i in range(1000)] + [(1, "x", 5.5)] * 3
    b = [(1, "x", i + 1e-10) for i in range(1000)] + [(1, "x", 5.5)]
    got = keyed(spark, a, b, keys=["k"], rtol=0.0, atol=1e-8)
    # Two copies more on one side: positions after them shift, two rows stay alone.
    assert sum(r[1] == "missing" for r in got) == 2 and sum(r[1] == "extra" for r in got) == 0
    assert keyed(spark, a[:1000], b[:1000], keys=["k"], rtol=0.0, atol=1e-8) == []


def test_nan_and_null(spark):
    a = [(1, "x", float("nan")), (2, "y", None), (3, "z", None)]
    b = [(1, "x", float("nan")), (2, "y", None), (3, "z", 1.0)]
    assert keyed(spark, a, b, keys=["k"]) == [(3, "changed", "price")]


def test_only_floats_without_keys_is_refused(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        C.compare_keyed(df, df)


def test_rows_of_a_heavy_key_lie_in_many_pieces(spark, monkeypatch):
    """One key, values with a long common start and of a type that is no number: no piece holds a large share of them."""
    sizes = []
    plain = C.cut

    def spied(df, name="cut"):
        made = plain(df, name)
        if name == "pieces":
            sizes.extend(r["count"] for r in made.groupBy("_piece").count().collect())
        return made

    monkeypatch.setattr(C, "cut", spied)
    rows_ = spark.range(8000).select(F.lit(1).alias("k"), F.concat(F.lit("https://example.org/"), F.lpad(F.col("id").cast("string"), 9, "0")).cast("binary").alias("b"))
    other = rows_.withColumn("b", F.concat("b", F.lit("x").cast("binary")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = C.compare_keyed(rows_, other, ["k"])
        assert got.count() == 8000 and {r[0] for r in got.select("status").distinct().collect()} == {"changed"}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 16000 and len(sizes) >= 8 and max(sizes) < 16000 / 3
