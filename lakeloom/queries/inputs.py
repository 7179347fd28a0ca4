"""Inputs derived from the test tables, written once as SQL that Spark and the SQL check both run."""

# Edge log with NULL sources, self-loops and internal names.
EDGES = """
SELECT CASE WHEN l_linenumber=4 AND l_partkey%9=0 THEN CAST(NULL AS STRING)
            WHEN l_linenumber=3 AND l_partkey%7=0 THEN concat('c1.silver.t', CAST(l_suppkey%40 AS STRING))
            WHEN l_linenumber=2 AND l_partkey%5=0 THEN concat('c1.bronze.__materialization_mat_', CAST(l_partkey%50 AS STRING))
            ELSE concat('c1.bronze.t', CAST(l_partkey%50 AS STRING)) END AS source_table_full_name,
       concat('c1.silver.t', CAST(l_suppkey%40 AS STRING)) AS target_table_full_name,
       concat('c', CAST(l_linenumber AS STRING)) AS source_column_name,
       CASE WHEN l_linenumber=6 THEN CAST(NULL AS STRING) ELSE concat('c', CAST(l_linenumber AS STRING)) END AS target_column_name,
       CAST(l_shipdate AS DATE) AS event_date
FROM {lineitem}
UNION ALL
SELECT concat('c1.silver.t', CAST(l_suppkey%40 AS STRING)),
       concat('c1.gold.t', CAST(l_orderkey%30 AS STRING)),
       concat('c', CAST(l_linenumber AS STRING)),
       concat('c', CAST(l_linenumber AS STRING)),
       CAST(l_shipdate AS DATE)
FROM {lineitem}
"""

# Layered graph: every node of layer k+1 has two parents in layer k; one edge closes a cycle.
GRAPH = """
SELECT concat('c1.l', CAST(o_orderkey%6 AS STRING), '.t', CAST(o_custkey%40 AS STRING)) AS source_table_full_name,
       concat('c1.l', CAST(o_orderkey%6+1 AS STRING), '.t', CAST((o_custkey%40 - o_custkey%2) / 2 AS INT)) AS target_table_full_name,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS event_date,
       CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS event_time,
       CASE o_orderstatus WHEN 'F' THEN 'PIPELINE' WHEN 'O' THEN 'NOTEBOOK' ELSE 'JOB' END AS entity_type
FROM {orders}
UNION ALL
SELECT 'c1.l6.t0', 'c1.l0.t0', max(CAST(date_trunc('year', o_orderdate) AS DATE)),
       max(CAST(date_trunc('year', o_orderdate) AS TIMESTAMP)), 'JOB'
FROM {orders}
"""

# Daily snapshots: the last event of each user and day.
SNAPSHOTS = """
SELECT user_id, day, event_type, value FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type, value,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM {events}) AS ranked
WHERE rn = 1
"""

# The other side of a comparison: rows missing, changed and doubled.
ALTERED_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey%103=0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderkey%101<>0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey%103=0 THEN o_totalprice + 1 ELSE o_totalprice END,
       o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderkey%101<>0 AND o_orderkey%107=0
"""

# Orders with holes, for the quality rules.
ORDERS_WITH_HOLES = """
SELECT o_orderkey, CASE WHEN o_orderkey%13=0 THEN CAST(NULL AS BIGINT) ELSE o_custkey END AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM {orders}
"""
