from pyspark.sql import functions as F

from lakeloom.functions import text, times, units
from lakeloom.functions.nested import flatten
from tests.helpers import rows


def values(spark, data, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in rows(df.select("i", build(F.col("v"))))]


def test_cron_text(spark):
    crons = ["0 30 6 * * ?", "5 0 12 * * MON", "0 0 1 15 * ?", "0 0 1 15 * MON", None, "  0  1 2 * * ? "]
    assert values(spark, crons, text.cron_text) == [
        "At 6:30:0 every day", "At 12:0:5 on every MON", "At 1:0:0 on day 15 of the month", "At 1:0:0", None, "At 2:1:0 every day"]


def test_email_user(spark):
    emails = ["a.b_c-d@x.org", "plain", "@x.org", None, "a@b@c"]
    assert values(spark, emails, text.email_user) == ["a_b_c-d", None, None, None, "a"]


def test_identifier_replaces_all_marks(spark):
    assert len(text.NOT_IN_IDENTIFIER) == 27 and len(set(text.NOT_IN_IDENTIFIER)) == 27
    got = values(spark, [text.NOT_IN_IDENTIFIER, "Côte d'Ivoire", "A_1*"], text.identifier)
    assert got == ["_" * 27, "côte_d_ivoire", "a_1*"]


def test_name_parts_of_short_names(spark):
    df = spark.createDataFrame([("a.b.c",), ("a.b",), ("",), (None,)], "n string")
    got = rows(df.select(*text.name_parts(F.col("n"))))
    assert got == sorted([("a", "b", "c"), ("a", "b", None), ("", None, None), (None, None, None)], key=repr)


def test_classify_and_translate(spark):
    got = values(spark, ["My Salary", "office training", "x", None], lambda c: text.classify(c, text.PAYMENT_CATEGORIES, "General"))
    assert got == ["Payroll", "Education", "General", "General"]
    assert values(spark, ["a", "q", None], lambda c: text.translate_by(c, {"a": "A"})) == ["A", None, None]


def test_underscore_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c  d` int")
    assert text.underscore_names(df).columns == ["a_b", "c__d"]


def test_stamps_and_labels(spark):
    stamps = values(spark, ["customer_20250301123456.parquet", "none"], lambda c: times.stamp_in(c, *times.COMPACT_STAMP).cast("string"))
    assert stamps == ["2025-03-01 12:34:56", None]
    zulu = values(spark, ["/x/m_20250301T010203Z.parquet"], lambda c: times.stamp_in(c, *times.ZULU_STAMP).cast("string"))
    assert zulu == ["2025-03-01 01:02:03"]
    assert values(spark, [0, 7, 59], lambda c: times.window_label(c, 15), "int") == ["00-15", "00-15", "45-60"]
    assert values(spark, [-1, 0, 86400], lambda c: times.epoch_date(c).cast("string"), "bigint") == ["1969-12-31", "1970-01-01", "1970-01-02"]


def test_miles(spark):
    assert abs(values(spark, [10.0], units.miles_to_km, "double")[0] - 16.0934) < 1e-5


def test_flatten_expands_structs_and_arrays(spark):
    df = spark.sql(
        """SELECT 1 AS id, array(named_struct('a', 1, 'b', named_struct('c', 'x')), named_struct('a', 2, 'b', named_struct('c', 'y'))) AS zones,
           map('k', 'v') AS m"""
    )
    flat = flatten(df)
    assert sorted(flat.columns) == ["a", "b_c", "id", "m"]
    assert rows(flat.select("id", "a", "b_c")) == [(1, 1, "x"), (1, 2, "y")]


def test_flatten_empty_arrays_and_flat_frames(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array(1, 2)), (2, array()), (3, NULL) AS t(id, xs)")
    assert [r[0] for r in rows(flatten(df))] == [1, 1]
    assert [r[0] for r in rows(flatten(df, keep_empty=True))] == [1, 1, 2, 3]
    plain = spark.range(2)
    assert flatten(plain).columns == ["id"]


def test_flatten_cuts_the_first_complex_name_only(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS first, named_struct('y', 2) AS second")
    assert flatten(df).columns == ["x", "second_y"] or sorted(flatten(df).columns) == ["second_y", "x"]
