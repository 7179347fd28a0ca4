"""Joins, aggregations, ranking, limits and set operations on the star schema."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import filters, lineage, quality, rows
from lakeloom.queries.base import query
from lakeloom.sinks.tables import fan_out
from lakeloom.sources.files import read_files
from lakeloom.queries.inputs import ALTERED_ORDERS, EDGES
from lakeloom.queries.lineage import _LATEST


@query(
    "j1_inner_join",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
)
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query(
    "j2_latest_rows_join",
    """SELECT event_id, user_id, event_type, e.ts FROM {events} e
       JOIN (SELECT event_type AS k, max(CAST(ts AS DATE)) AS d FROM {events} GROUP BY 1) m ON event_type = k AND CAST(ts AS DATE) = d""",
)
def _(t):
    events = t.events.withColumn("day", F.to_date("ts"))
    newest = events.groupBy("event_type").agg(F.max("day").alias("day"))
    return events.join(newest, ["event_type", "day"]).select("event_id", "user_id", "event_type", "ts")


@query(
    "j3_left_join",
    """SELECT d.doc_id, lang, quality, toxic FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
)
def _(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@query(
    "j4_left_star_join",
    """SELECT o_orderkey, c_name, n_name, r_name FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey
       LEFT JOIN {nation} ON c_nationkey = n_nationkey LEFT JOIN {region} ON n_regionkey = r_regionkey""",
)
def _(t):
    # nation and region are broadcast by Spark's own size limit, not by a hint.
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query(
    "j5_left_anti_join",
    "SELECT doc_id, lang FROM {documents} WHERE doc_id NOT IN (SELECT doc_id FROM {labels})",
)
def _(t):
    return filters.rows_not_in(t.documents, t.labels, ["doc_id"]).select("doc_id", "lang")


@query(
    "j6_left_semi_join",
    """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT')""",
)
def _(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return filters.rows_in(t.customer, urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "j7_counts_side_by_side",
    "SELECT (SELECT count(*) FROM {documents}) AS source_count, (SELECT count(*) FROM {labels}) AS target_count",
)
def _(t):
    return quality.count_check(t.documents, t.labels).drop("no_rows_dropped")


@query(
    "j8_one_stage_join",
    _LATEST
    + "SELECT source_table_full_name AS stage_1, target_table_full_name AS stage_0 FROM latest",
)
def _(t):
    return lineage.table_stages(t.sql(EDGES), 1).select("stage_1", "stage_0")


@query(
    "j9_column_join_one_table",
    f"""WITH edges AS ({EDGES}),
newest AS (SELECT target_table_full_name AS t, max(event_date) AS d FROM edges GROUP BY 1),
latest AS (SELECT DISTINCT source_table_full_name AS s, source_column_name AS sc, target_table_full_name AS t, target_column_name AS tc
  FROM edges JOIN newest ON target_table_full_name = t AND event_date = d
  WHERE source_column_name IS NOT NULL AND target_column_name IS NOT NULL AND source_table_full_name <> target_table_full_name
    AND split_part(source_table_full_name, '.', 3) NOT LIKE '__materialization_%')
SELECT s AS stage_1_table, sc AS stage_1_column, t AS stage_0_table, tc AS stage_0_column FROM latest WHERE t = 'c1.silver.t7'""",
)
def _(t):
    return lineage.column_stages(t.sql(EDGES), 1, table="c1.silver.t7").select(
        "stage_1_table", "stage_1_column", "stage_0_table", "stage_0_column"
    )


@query(
    "j10_left_chain_join",
    f"""WITH edges AS (SELECT * FROM ({EDGES}) x WHERE source_table_full_name <> target_table_full_name),
newest AS (SELECT target_table_full_name AS t, max(event_date) AS d FROM edges GROUP BY 1),
latest AS (SELECT DISTINCT source_table_full_name AS s, target_table_full_name AS t FROM edges JOIN newest n ON target_table_full_name = n.t AND event_date = d)
SELECT c.s AS stage_0, b.s AS stage_1, r.t AS stage_2, 1 AS value, r.t AS target_table,
  split_part(r.t, '.', 1) AS target_catalog, split_part(r.t, '.', 2) AS target_schema
FROM (SELECT DISTINCT t FROM latest) r LEFT JOIN latest b ON b.t = r.t LEFT JOIN latest c ON c.t = b.s""",
)
def _(t):
    return lineage.all_paths(t.sql(EDGES), "c1.", 2)


@query(
    "j11_full_outer_diff",
    f"""WITH b AS (SELECT o_orderkey, max(o_totalprice) AS price FROM ({ALTERED_ORDERS}) x GROUP BY 1)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_totalprice AS left_price, b.price AS right_price
FROM {{orders}} a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_totalprice IS DISTINCT FROM b.price""",
)
def _(t):
    left = t.orders.select("o_orderkey", F.col("o_totalprice").alias("left_price"))
    right = t.sql(ALTERED_ORDERS).groupBy("o_orderkey").agg(F.max("o_totalprice").alias("right_price"))
    both = left.join(right, "o_orderkey", "full_outer")
    return both.filter(~F.col("left_price").eqNullSafe(F.col("right_price")))


@query("a1_count", "SELECT count(*) AS n FROM {lineitem}")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("a2_min_max", "SELECT min(ts) AS first, max(ts) AS last FROM {events}")
def _(t):
    return t.events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(
    "a3_rows_of_newest_day",
    "SELECT event_id, user_id FROM {events} WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM {events})",
)
def _(t):
    events = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    return rows.equals_global_max(events, "day").drop("day")


@query("a4_max_per_group", "SELECT l_suppkey, max(l_shipdate) AS newest FROM {lineitem} GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("newest"))


@query("a5_count_per_key", "SELECT o_custkey, count(*) AS num_entries FROM {orders} GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("num_entries"))


@query(
    "a8_sum_per_month",
    "SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, round(sum(o_totalprice), 2) AS total_sales FROM {orders} GROUP BY 1",
)
def _(t):
    return t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_sales")
    )


@query(
    "a9_edge_multiplicity",
    """SELECT o_custkey % 40 AS source, o_orderkey % 30 AS target, count(*) AS value FROM {orders} GROUP BY 1, 2""",
)
def _(t):
    return t.orders.groupBy(
        (F.col("o_custkey") % 40).alias("source"), (F.col("o_orderkey") % 30).alias("target")
    ).agg(F.count(F.lit(1)).alias("value"))


@query("a10_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM {lineitem}")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


_SUMMARY_COLUMNS = (("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False))


@query(
    "a11_column_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, {f"round(avg({c}), 6)" if n else "CAST(NULL AS DOUBLE)"} AS mean,
        {f"round(stddev({c}), 6)" if n else "CAST(NULL AS DOUBLE)"} AS stddev, CAST(min({c}) AS STRING) AS min, CAST(max({c}) AS STRING) AS max,
        count(*) AS row_count, 5 AS column_count FROM {{customer}}"""
        for c, n in _SUMMARY_COLUMNS
    ),
)
def _(t):
    return rows.summary_rows(t.customer).withColumns(
        {"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)}
    )


@query(
    "w1_newest_per_key",
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
       (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {orders}) x WHERE rn = 1""",
)
def _(t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return rows.newest(t.orders, ["o_custkey", "o_orderstatus"], order).select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate"
    )


@query(
    "w3_order_by",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM {orders} ORDER BY o_orderdate DESC, o_orderkey",
)
def _(t):
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        F.col("o_orderdate").desc(), "o_orderkey"
    )


@query(
    "w4_limit",
    "SELECT c_custkey, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
)
def _(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(10)


@query(
    "w5_all_but_last",
    "SELECT c_custkey, c_name FROM {customer} WHERE c_custkey <> (SELECT max(c_custkey) FROM {customer})",
)
def _(t):
    return rows.all_but_last(t.customer, "c_custkey").select("c_custkey", "c_name")


@query(
    "w6_first_of_list",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM {orders} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return spent.orderBy(F.col("spent").desc(), "o_custkey").limit(5)


@query(
    "u1_union_all",
    """SELECT c_custkey AS id, c_name AS name FROM {customer} UNION ALL SELECT s_suppkey, s_name FROM {supplier}""",
)
def _(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return customers.union(t.supplier.select("s_suppkey", "s_name"))


@query("u2_union_of_many", "SELECT event_id, event_type, value FROM {events}")
def _(t):
    """One table per event type, whichever types there are, all of them read again by their name pattern in one scan."""
    folder = t.scratch("kinds")
    fan_out(t.events.select("event_id", "event_type", "value"), "event_type", folder)
    return read_files(t.spark, f"{folder}/part_of=*").select("event_id", "event_type", "value")


@query(
    "u3_union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM {customer}
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM {supplier}""",
)
def _(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "u4_union_fold",
    """SELECT p_partkey AS id, p_name AS name FROM {part} UNION ALL SELECT c_custkey, c_name FROM {customer}
       UNION ALL SELECT s_suppkey, s_name FROM {supplier}""",
)
def _(t):
    frames = [
        df.select(F.col(key).alias("id"), F.col(name).alias("name"))
        for df, key, name in (
            (t.part, "p_partkey", "p_name"),
            (t.customer, "c_custkey", "c_name"),
            (t.supplier, "s_suppkey", "s_name"),
        )
    ]
    return rows.union_all_by_name(frames)


@query(
    "u5_union_distinct",
    """SELECT l_suppkey AS id FROM {lineitem} UNION SELECT s_suppkey FROM {supplier} UNION SELECT o_custkey FROM {orders}
       UNION SELECT c_custkey FROM {customer} UNION SELECT p_partkey FROM {part}""",
)
def _(t):
    pairs = (
        (t.lineitem, "l_suppkey"),
        (t.supplier, "s_suppkey"),
        (t.orders, "o_custkey"),
        (t.customer, "c_custkey"),
        (t.part, "p_partkey"),
    )
    return rows.union_distinct([df.select(F.col(c).alias("id")) for df, c in pairs])


@query("u6_except_all", f"SELECT * FROM ({ALTERED_ORDERS}) a EXCEPT ALL SELECT * FROM {{orders}}")
def _(t):
    return t.sql(ALTERED_ORDERS).exceptAll(t.orders)


@query("u7_except", f"SELECT * FROM {{orders}} EXCEPT SELECT * FROM ({ALTERED_ORDERS}) a")
def _(t):
    return t.orders.subtract(t.sql(ALTERED_ORDERS))
