"""Queries on comparison, quality rules and generated data."""

from functools import reduce

from pyspark.sql import functions as F

from lakeloom.operators import compare as C
from lakeloom.operators import quality as Q
from lakeloom.plans import generators as N
from lakeloom.queries.base import query
from lakeloom.queries.inputs import ALTERED_ORDERS, ORDERS_WITH_HOLES

_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query(
    "c1_schema_diff",
    """SELECT column_name, source_type, target_type, status, CASE column_name WHEN 'o_clerk' THEN 0 ELSE (SELECT count(*) FROM {orders}) END AS source_values,
       CASE column_name WHEN 'o_orderpriority' THEN 0 ELSE (SELECT count(*) FROM {orders}) END AS target_values
    FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'equal'), ('o_custkey', 'bigint', 'bigint', 'equal'), ('o_orderstatus', 'string', 'string', 'equal'),
      ('o_totalprice', 'double', 'float', 'type'), ('o_orderdate', 'timestamp_ntz', 'date', 'type'),
      ('o_orderpriority', 'string', NULL, 'missing'), ('o_clerk', NULL, 'string', 'extra')) v(column_name, source_type, target_type, status)""",
)
def _(t):
    """Schema differences with the number of values each side holds in the column."""
    source = t.orders
    target = source.drop("o_orderpriority").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("float"),
            "o_orderdate": F.to_date("o_orderdate"),
            "o_clerk": F.col("o_orderstatus"),
        }
    )

    def values(df, name):
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in df.columns]
        return df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.inline(F.array(*entries)))

    diff = C.schema_diff(source, target)
    counted = diff.join(values(source, "source_values"), "column_name", "left").join(
        values(target, "target_values"), "column_name", "left"
    )
    return counted.na.fill(0, ["source_values", "target_values"])


@query(
    "c2_compare",
    f"""WITH b AS ({ALTERED_ORDERS}),
signed AS (SELECT {_ORDER_COLUMNS}, 1 AS n FROM {{orders}} UNION ALL SELECT {_ORDER_COLUMNS}, -1 FROM b)
SELECT {_ORDER_COLUMNS}, CASE WHEN sum(n) > 0 THEN 'source' ELSE 'target' END AS side, CAST(abs(sum(n)) AS BIGINT) AS surplus
FROM signed GROUP BY ALL HAVING sum(n) <> 0""",
)
def _(t):
    return C.compare(t.orders, t.sql(ALTERED_ORDERS))


@query(
    "c2_compare_keyed",
    f"""WITH b AS ({ALTERED_ORDERS}),
left_a AS (SELECT * FROM {{orders}} EXCEPT ALL SELECT * FROM b), left_b AS (SELECT * FROM b EXCEPT ALL SELECT * FROM {{orders}}),
num_a AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_totalprice) AS n FROM left_a),
num_b AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_totalprice) AS n FROM left_b)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
  CASE WHEN a.n IS NOT NULL AND b.n IS NOT NULL THEN 'o_totalprice' END AS changed_columns
FROM num_a a FULL JOIN num_b b ON a.o_orderkey = b.o_orderkey AND a.n = b.n
WHERE a.n IS NULL OR b.n IS NULL OR abs(a.o_totalprice - b.o_totalprice) > 1e-8 + 1e-7 * abs(b.o_totalprice)""",
)
def _(t):
    return C.compare_keyed(t.orders, t.sql(ALTERED_ORDERS), ["o_orderkey"], rtol=1e-7)


def _entities(t):
    extra = t.part.agg(F.max("p_partkey").alias("top")).select(
        (F.col("top") + 1).alias("p_partkey"), F.lit("one more").alias("p_name"), F.lit("Brand#0").alias("p_brand"),
        F.lit("ECONOMY").alias("p_type"), F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    customers = t.customer.withColumn(
        "signup_date", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int"))
    )
    return N.four_schemas(customers, t.orders, t.part, t.lineitem, "c_custkey", extra, "signup_date")


_VERDICTS = """SELECT source_schema, target_schema, entity, CAST(schema_equal AS BOOLEAN) AS schema_equal,
  CAST(source_only AS BIGINT) AS source_only, CAST(target_only AS BIGINT) AS target_only, CAST(equal AS BOOLEAN) AS equal FROM (VALUES {}
) v(source_schema, target_schema, entity, schema_equal, source_only, target_only, equal)"""
_ALL = "('schema1', '{0}', '{1}', true, 0, 0, true)"
_ROWS = ",\n".join(
    {
        ("schema3", "customers"): "('schema1', 'schema3', 'customers', true, 1, 0, false)",
        ("schema3", "products"): "('schema1', 'schema3', 'products', true, 0, 1, false)",
        ("schema4", "customers"): "('schema1', 'schema4', 'customers', false, NULL, NULL, false)",
    }.get((s, e), _ALL.format(s, e))
    for s in ("schema2", "schema3", "schema4")
    for e in ("customers", "orders", "products", "order_items")
)


@query("c3_compare_all", _VERDICTS.replace("{}", _ROWS))
def _(t):
    return C.compare_all(
        _entities(t), [("schema1", "schema2"), ("schema1", "schema3"), ("schema1", "schema4")]
    )


@query(
    "n4_compare_set",
    """SELECT entity, schema, rows FROM (
      SELECT 'customers' AS entity, s AS schema, (SELECT count(*) FROM {customer}) - CASE s WHEN 'schema3' THEN 1 ELSE 0 END AS rows FROM (VALUES ('schema1'), ('schema2'), ('schema3'), ('schema4')) v(s)
      UNION ALL SELECT 'orders', s, (SELECT count(*) FROM {orders}) FROM (VALUES ('schema1'), ('schema2'), ('schema3'), ('schema4')) v(s)
      UNION ALL SELECT 'products', s, (SELECT count(*) FROM {part}) + CASE s WHEN 'schema3' THEN 1 ELSE 0 END FROM (VALUES ('schema1'), ('schema2'), ('schema3'), ('schema4')) v(s)
      UNION ALL SELECT 'order_items', s, (SELECT count(*) FROM {lineitem}) FROM (VALUES ('schema1'), ('schema2'), ('schema3'), ('schema4')) v(s)) x""",
)
def _(t):
    counts = [
        frame.agg(F.lit(entity).alias("entity"), F.lit(schema).alias("schema"), F.count(F.lit(1)).alias("rows"))
        for schema, entities in _entities(t).items()
        for entity, frame in entities.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _rules():
    return {
        "has_customer": F.col("o_custkey").isNotNull(),
        "valid_price": F.col("o_totalprice").between(1000, 400000),
        "small_customer": F.col("o_custkey") < 1000,
    }


_SMALL = "o_custkey IS NOT NULL AND o_totalprice BETWEEN 1000 AND 400000 AND coalesce(o_custkey < 1000, false)"


@query(
    "q1_expect_warn",
    f"""WITH o AS ({ORDERS_WITH_HOLES})
SELECT 'has_customer' AS rule, count(*) FILTER (o_custkey IS NOT NULL) AS passed, count(*) FILTER (o_custkey IS NULL) AS failed FROM o
UNION ALL SELECT 'valid_price', count(*) FILTER (o_totalprice BETWEEN 1000 AND 400000), count(*) FILTER (NOT o_totalprice BETWEEN 1000 AND 400000) FROM o
UNION ALL SELECT 'small_customer', count(*) FILTER (o_custkey < 1000), count(*) FILTER (coalesce(o_custkey >= 1000, true)) FROM o""",
)
def _(t):
    return Q.expect(t.sql(ORDERS_WITH_HOLES), _rules(), "warn").metrics


@query("q1_expect_drop", f"SELECT * FROM ({ORDERS_WITH_HOLES}) o WHERE {_SMALL}")
def _(t):
    return Q.expect(t.sql(ORDERS_WITH_HOLES), _rules(), "drop").rows


@query(
    "q1_expect_fail",
    f"""SELECT *, CASE WHEN EXISTS (SELECT 1 FROM ({ORDERS_WITH_HOLES}) o WHERE o_custkey IS NULL) THEN 'has_customer' END AS stopped_by FROM {{orders}}""",
)
def _(t):
    """Rules that hold let all rows through; a table with holes stops the job, which names the rule."""
    rows = Q.expect(t.orders, {"has_key": F.col("o_orderkey").isNotNull(), "price": F.col("o_totalprice") >= 0}, "fail").rows
    stopped = None
    try:
        Q.expect(t.sql(ORDERS_WITH_HOLES), {"has_customer": F.col("o_custkey").isNotNull()}, "fail").rows.write.format("noop").mode("overwrite").save()
    except Exception as error:  # the task's message is the result; anything else is raised
        if "expectation failed: has_customer" not in str(error):
            raise
        stopped = "has_customer"
    return rows.withColumn("stopped_by", F.lit(stopped).cast("string"))


@query(
    "q2_count_check",
    f"""SELECT count(*) AS source_count, count(*) FILTER ({_SMALL}) AS target_count, count(*) = count(*) FILTER ({_SMALL}) AS no_rows_dropped
    FROM ({ORDERS_WITH_HOLES}) o""",
)
def _(t):
    orders = t.sql(ORDERS_WITH_HOLES)
    return Q.count_check(orders, Q.expect(orders, _rules(), "drop").rows)


@query(
    "q3_missing_records",
    """SELECT d.doc_id, d.lang, l.doc_id AS target_key, l.doc_id IS NOT NULL AS no_missing_records
       FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
)
def _(t):
    return Q.missing_records(t.documents.select("doc_id", "lang"), t.labels, "doc_id").withColumn(
        "no_missing_records", Q.holds(F.col("target_key").isNotNull())
    )


@query(
    "q4_key_uniqueness",
    f"SELECT o_orderkey, count(*) AS num_entries, count(*) = 1 AS unique_pk FROM ({ALTERED_ORDERS}) o GROUP BY 1",
)
def _(t):
    return Q.key_counts(t.sql(ALTERED_ORDERS), ["o_orderkey"])


@query("q5_quarantine", f"SELECT *, NOT ({_SMALL}) AS is_quarantined FROM ({ORDERS_WITH_HOLES}) o")
def _(t):
    return Q.quarantine(t.sql(ORDERS_WITH_HOLES), _rules())


@query(
    "q5_quarantine_split",
    f"""SELECT 'valid' AS side, o_orderstatus, count(*) AS n FROM ({ORDERS_WITH_HOLES}) o WHERE {_SMALL} GROUP BY 2
    UNION ALL SELECT 'invalid', o_orderstatus, count(*) FROM ({ORDERS_WITH_HOLES}) o WHERE NOT ({_SMALL}) GROUP BY 2""",
)
def _(t):
    flagged = Q.quarantine(t.sql(ORDERS_WITH_HOLES), _rules())
    sides = (("valid", Q.valid(flagged)), ("invalid", Q.invalid(flagged)))
    counts = [
        rows.groupBy(F.lit(side).alias("side"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
        for side, rows in sides
    ]
    return counts[0].unionByName(counts[1])


def _hex(field, below):
    return f"CAST(CAST('0x' || substr(d, {4 * field + 1}, 4) AS INT) % {below} AS INT)"


def _item(field, values):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_hex(field, len(values))} + 1]"


_KEY = "concat_ws('-', substr(d, 1, 8), substr(d, 9, 4), substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12))"
_BORN = f"CAST(DATE '2025-01-01' - {_hex(2, 36525)} AS DATE)"


@query(
    "n1_fake_customers",
    f"""WITH rows AS (SELECT sha256('1|' || c_custkey) AS d FROM {{customer}})
SELECT {_KEY} AS primary_key, {_item(0, N.FIRST_NAMES)} AS name, {_item(1, N.LAST_NAMES)} AS surname, {_BORN} AS date_of_birth,
  {_item(3, N.COUNTRIES)} AS nationality, {_item(4, N.STREETS)} || ' ' || ({_hex(5, 200)} + 1) AS address,
  '+41 ' || lpad(CAST({_hex(6, 10000)} AS STRING), 4, '0') AS phone_number,
  lower({_item(0, N.FIRST_NAMES)} || '.' || {_item(1, N.LAST_NAMES)} || '@example.com') AS email, {_item(7, N.RELIGIONS)} AS religion,
  {_hex(8, 82)} + 18 AS age, {_item(9, N.EDUCATION)} AS education, {_item(10, N.OCCUPATIONS)} AS occupation, {_hex(11, 90001)} + 10000 AS income,
  {_item(12, N.MARITAL_STATUS)} AS marital_status, {_item(13, N.SEX)} AS sex, {_item(14, N.HOBBIES)} AS hobby FROM rows""",
)
def _(t):
    return N.fake_customers(t.customer, "c_custkey")


_DAYS = 5
_ARRIVALS = f"""rows AS (SELECT sha256('2|' || c_custkey) AS d, CAST(c_custkey % {_DAYS} + 1 AS INT) AS step FROM {{customer}}),
arriving AS (SELECT {_KEY} AS primary_key, {_item(0, N.FIRST_NAMES)} AS name, {_item(1, N.LAST_NAMES)} AS surname, {_BORN} AS date_of_birth,
  {_item(3, N.COUNTRIES)} AS country, CAST({_hex(8, 82)} + 18 AS BIGINT) AS age, step FROM rows)"""
_FOLDERS = 'CAST(year(day) AS INT) AS "Year", CAST(month(day) AS INT) AS "Month", CAST(day(day) AS INT) AS "Day"'


def _arrivals(t):
    step = (F.col("c_custkey") % _DAYS + 1).cast("int")
    return N.arrivals(t.customer.withColumn("step", step), "c_custkey", "step")


@query(
    "n2_daily_snapshots",
    f"""WITH {_ARRIVALS},
scripted AS (SELECT primary_key, CASE WHEN stage >= changes THEN 'UPDATED' ELSE name END AS name,
   CASE WHEN stage >= changes THEN 'UPDATED' ELSE surname END AS surname, CAST(born AS DATE) AS date_of_birth, country, CAST(age AS BIGINT) AS age, stage
   FROM (VALUES {", ".join(str(tuple(r)).replace("None", "NULL") for r in N.SCRIPTED)}) v(primary_key, name, surname, born, country, age, changes, leaves),
        (SELECT CAST(unnest(range(1, {_DAYS + 1})) AS INT) AS stage) s WHERE leaves IS NULL OR stage < leaves),
grown AS (SELECT primary_key, name, surname, date_of_birth, country, age, stage FROM arriving, (SELECT CAST(unnest(range(1, {_DAYS + 1})) AS INT) AS stage) s WHERE stage >= step),
rows_by_day AS (SELECT *, CAST(DATE '2025-03-01' + (stage - 1) AS DATE) AS day FROM (SELECT * FROM grown UNION ALL SELECT * FROM scripted) x)
SELECT primary_key, name, surname, date_of_birth, country, age, {_FOLDERS}, day AS snapshot_date FROM rows_by_day""",
)
def _(t):
    return N.daily_snapshots(_arrivals(t), _DAYS, "2025-03-01")


@query(
    "n3_daily_increments",
    f"""WITH {_ARRIVALS}, dated AS (SELECT *, CAST(DATE '2025-03-01' + (step - 1) AS DATE) AS day FROM arriving)
SELECT primary_key, name, surname, date_of_birth, country, age, {_FOLDERS} FROM dated""",
)
def _(t):
    return N.daily_increments(_arrivals(t), "2025-03-01")


@query(
    "f14_repeatable_picks",
    f"""WITH rows AS (SELECT o_orderkey, sha256('7|' || o_orderkey) AS d FROM {{orders}})
SELECT o_orderkey, {_KEY} AS row_key, {_item(0, N.HOBBIES)} AS hobby, {_hex(3, 100)} AS score FROM rows""",
)
def _(t):
    d = N.digest(F.col("o_orderkey"), 7)
    return t.orders.select(
        "o_orderkey", N.uuid_of(d).alias("row_key"), N.pick(d, 0, N.HOBBIES).alias("hobby"), N.number(d, 3, 100).alias("score")
    )
