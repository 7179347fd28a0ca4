"""Queries on sources, sinks and versioned tables."""

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import versions as V
from lakeloom.queries.base import TABLES, query
from lakeloom.sinks import tables as K
from lakeloom.sources import files as S

_SMALL_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _table_name(kind):
    return f"{kind}_{uuid4().hex[:12]}"


@query("s1_parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem} WHERE l_discount > 0.05")
def _(t):
    return S.read_files(t.spark, t.path("lineitem")).filter(F.col("l_discount") > 0.05).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


def _orders_as_csv(t, header):
    folder = t.scratch("csv")
    t.orders.select(*_SMALL_ORDERS.split(", ")).write.option("header", header).csv(folder)
    return folder


@query(
    "s2_csv_without_options",
    """SELECT CAST(o_orderkey AS STRING) AS _c0, CAST(o_custkey AS STRING) AS _c1, o_orderstatus AS _c2, CAST(o_totalprice AS DOUBLE) AS _c3, o_orderpriority AS _c4 FROM {orders}""",
)
def _(t):
    # The engines write doubles as text in different ways, so the price is compared as a number.
    return S.csv_rows(t.spark, _orders_as_csv(t, False)).withColumn("_c3", F.col("_c3").cast("double"))


@query("s3_csv_with_header", f"SELECT {_SMALL_ORDERS} FROM {{orders}}")
def _(t):
    found = S.csv_table(t.spark, _orders_as_csv(t, True))
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("s4_json_documents", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}")
def _(t):
    """Customers in documents of 5,000, each a JSON list over many lines in its own file."""
    folder = t.scratch("json")
    entry = F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    documents = (
        t.customer.select(F.floor(F.col("c_custkey") / 5000).alias("document"), entry.alias("entry"))
        .groupBy("document")
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("entry"), ",\n"), F.lit("\n]")).alias("value"))
    )
    documents.write.partitionBy("document").text(folder)
    kinds = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return S.json_documents(t.spark, folder, kinds).drop("document")


@query("s5_captured_messages", "SELECT event_id AS \"SequenceNumber\", props AS body_string FROM {events}")
def _(t):
    """Message captures in date folders, here as Parquet."""
    folder = t.scratch("capture")
    messages = t.events.select(
        F.col("event_id").alias("SequenceNumber"),
        F.col("props").cast("binary").alias("Body"),
        F.date_format("ts", "yyyy").alias("y"),
        F.date_format("ts", "MM").alias("m"),
        F.date_format("ts", "dd").alias("d"),
    )
    K.write_folders(messages, folder, ["y", "m", "d"])
    found = S.captured_messages(t.spark, f"{folder}/*/*/*/*.parquet", "parquet")
    return found.select("SequenceNumber", F.col("Body").cast("string").alias("body_string"))


@query("s6_sql_on_files", "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1")
def _(t):
    folder = _orders_as_csv(t, True)
    text = "SELECT o_orderstatus, count(*) AS n FROM {files} GROUP BY o_orderstatus"
    return S.sql_on_files(t.spark, text, f"{folder}/*.csv", "csv", header=True)


@query("s7_named_table", "SELECT * FROM {supplier}")
def _(t):
    name = _table_name("supplier")
    K.save_table(t.supplier, name, path=t.scratch("table"))
    return t.spark.table(name)


@query(
    "s8_literal_rows",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'row' WHEN '2-HIGH' THEN 'tuple' WHEN '3-MEDIUM' THEN 'ddl'
       WHEN '4-NOT SPECIFIED' THEN 'dict' ELSE 'pandas' END AS form FROM {orders}""",
)
def _(t):
    import pandas as pd

    make = t.spark.createDataFrame
    kind = T.StructType([T.StructField("o_orderpriority", T.StringType()), T.StructField("form", T.StringType())])
    literal = [
        make([Row(o_orderpriority="1-URGENT", form="row")]),
        make([("2-HIGH", "tuple")], ["o_orderpriority", "form"]),
        make([("3-MEDIUM", "ddl")], "o_orderpriority string, form string"),
        make([{"o_orderpriority": "4-NOT SPECIFIED", "form": "dict"}], kind),
        make(pd.DataFrame({"o_orderpriority": ["5-LOW"], "form": ["pandas"]})),
    ]
    forms = literal[0]
    for more in literal[1:]:
        forms = forms.unionByName(more)
    return t.orders.join(forms, "o_orderpriority").select("o_orderkey", "form")


@query(
    "s9_integer_range",
    """WITH ids AS (SELECT unnest(range((SELECT min(o_orderkey) FROM {orders}), (SELECT max(o_orderkey) + 1 FROM {orders}), 100)) AS id)
    SELECT id, count(o_orderkey) AS n FROM ids LEFT JOIN {orders} ON o_orderkey - (o_orderkey - (SELECT min(o_orderkey) FROM {orders})) % 100 = id GROUP BY 1""",
)
def _(t):
    """Blocks of 100 keys over the key range, with the orders of each."""
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    block = F.col("o_orderkey") - (F.col("o_orderkey") - low) % 100
    counts = t.orders.groupBy(block.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return t.spark.range(low, high + 1, 100).join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "s10_date_sequence",
    """WITH days AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM {orders}), (SELECT max(o_orderdate) FROM {orders}), INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT day, count(o_orderkey) AS n FROM days LEFT JOIN {orders} ON CAST(o_orderdate AS DATE) = day GROUP BY 1""",
)
def _(t):
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    days = ends.select(F.explode(F.expr("sequence(lo, hi, INTERVAL 1 DAY)")).alias("day"))
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "s11_file_metadata",
    "SELECT event_id, 'events.parquet' AS file_name, true AS has_path, true AS has_size, true AS has_block, true AS has_time FROM {events}",
)
def _(t):
    meta = F.col("_metadata")
    return t.events.select(
        "event_id",
        meta["file_name"].alias("file_name"),
        meta["file_path"].endswith("/events.parquet").alias("has_path"),
        (meta["file_size"] > 0).alias("has_size"),
        ((meta["file_block_start"] >= 0) & (meta["file_block_length"] > 0)).alias("has_block"),
        meta["file_modification_time"].isNotNull().alias("has_time"),
    )


def _orders_by_month(t):
    folder = t.scratch("months")
    dated = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    K.write_folders(dated, folder, ["year", "month"])
    return folder


@query(
    "s12_partition_columns",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM {orders} WHERE year(o_orderdate) = 1998",
)
def _(t):
    found = S.read_files(t.spark, _orders_by_month(t))
    return found.filter(F.col("year") == 1998).select("o_orderkey", "year", "month")


@query(
    "s13_one_partition",
    "SELECT * FROM {orders} WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3",
)
def _(t):
    return S.one_partition(t.spark, _orders_by_month(t), year=1998, month=3)


_ROWS_OF = " UNION ALL ".join(f"SELECT '{n}.parquet' AS name, count(*) AS rows FROM {{{n}}}" for n in TABLES)


def _scanned(t):
    """The files of all tables, with their rows; the table's path is cut from the file's."""
    listed = [S.scanned_files(getattr(t, n).select()).withColumn("table", F.lit(f"{n}.parquet")) for n in TABLES]
    files = reduce(DataFrame.union, listed)
    return files.withColumn("file", F.expr("concat(table, substring_index(path, table, -1))"))


@query("s16_file_listing", f"SELECT name, rows, true AS has_size, true AS has_time FROM ({_ROWS_OF}) x")
def _(t):
    """Every file of the tables with its rows; files of a folder are listed by their place in it."""
    found = _scanned(t)
    return found.select(F.col("file").alias("name"), "rows", (F.col("size") > 0).alias("has_size"), F.col("modified").isNotNull().alias("has_time"))


@query(
    "s17_folder_sizes",
    "SELECT year(o_orderdate) AS year, count(DISTINCT month(o_orderdate)) AS months, count(*) AS rows, true AS has_bytes FROM {orders} GROUP BY 1",
)
def _(t):
    """Files, rows and bytes of the yearly folders of the orders, counted by the scan that reads them."""
    found = S.scanned_files(t.spark.read.parquet(_orders_by_month(t)).select())
    year = F.regexp_extract("path", "/year=([0-9]+)/", 1).cast("bigint").alias("year")
    month = F.regexp_extract("path", "/month=([0-9]+)/", 1)
    sums = found.groupBy(year).agg(F.countDistinct(month).alias("months"), F.sum("rows").alias("rows"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"))
    return sums.select("year", "months", "rows", ((F.col("bytes") > 0) & (F.col("files") >= F.col("months"))).alias("has_bytes"))


@query(
    "n5_manifest_diff",
    f"""SELECT name AS file, rows, CASE name WHEN 'nation.parquet' THEN 'missing' WHEN 'orders.parquet' THEN 'resized' ELSE 'same' END AS status
    FROM ({_ROWS_OF}) x""",
)
def _(t):
    """The files of the tables against a copy's manifest that lacks one file and has another size for one."""
    manifest = _scanned(t).select("file", "size", "rows")
    copy = manifest.filter(F.col("file") != "nation.parquet").withColumn(
        "size", F.col("size") + (F.col("file") == "orders.parquet").cast("int")
    )
    return S.manifest_diff(manifest, copy).select("file", "status").join(manifest.select("file", "rows"), "file")


@query("k1_write_folders", "SELECT *, CAST(year(o_orderdate) AS INT) AS year FROM {orders}")
def _(t):
    folder = t.scratch("folders")
    K.write_folders(t.orders.withColumn("year", F.year("o_orderdate")), folder, ["year"])
    return t.spark.read.parquet(folder)


@query("k2_table_overwrite", "SELECT * FROM {supplier}")
def _(t):
    name, folder = _table_name("overwritten"), t.scratch("table")
    K.save_table(t.supplier.withColumn("s_name", F.lit("old")), name, "overwrite", folder)
    return K.save_table(t.supplier, name, "overwrite", folder)


@query("k3_table_append", "SELECT * FROM {supplier} UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM {customer}")
def _(t):
    name, folder = _table_name("appended"), t.scratch("table")
    K.save_table(t.supplier, name, "append", folder)
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").toDF(*t.supplier.columns)
    return K.save_table(customers, name, "append", folder)


@query("k4_table_must_not_exist", "SELECT s_suppkey, s_name, true AS second_refused FROM {supplier}")
def _(t):
    name, rows = _table_name("once"), t.supplier.select("s_suppkey", "s_name")
    saved = K.save_table(rows, name, path=t.scratch("table"))
    try:
        K.save_table(rows, name, path=t.scratch("table"))
        refused = False
    except Exception as error:
        refused = "ALREADY_EXISTS" in str(error)
    return saved.withColumn("second_refused", F.lit(refused))


@query(
    "k5_append_with_new_columns",
    "SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM {supplier} UNION ALL SELECT s_suppkey + 1000000, s_name, s_acctbal FROM {supplier}",
)
def _(t):
    folder = t.scratch("merged")
    t.supplier.select("s_suppkey", "s_name").write.parquet(folder)
    more = t.supplier.select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), "s_name", "s_acctbal")
    return K.append_with_new_columns(more, folder)


@query("k6_replace_schema", "SELECT s_suppkey, s_acctbal, 'balances per supplier' AS comment FROM {supplier}")
def _(t):
    name, folder = _table_name("replaced"), t.scratch("table")
    K.save_table(t.supplier.select("s_suppkey", "s_name"), name, "overwrite", folder)
    saved = K.save_table(
        t.supplier.select("s_suppkey", "s_acctbal"), name, "overwrite", folder, comment="balances per supplier"
    )
    comment = t.spark.catalog.getTable(name).description
    return saved.withColumn("comment", F.lit(comment))


@query("k7_load_if_empty", "SELECT s_suppkey, s_name, true AS loaded_first, false AS loaded_again FROM {supplier}")
def _(t):
    folder, rows = t.scratch("guarded"), t.supplier.select("s_suppkey", "s_name")
    rows.limit(0).write.parquet(folder)
    read = lambda: t.spark.read.schema(rows.schema).parquet(folder)
    load = lambda: rows.write.mode("append").parquet(folder)
    first = K.load_if_empty(read(), load)
    again = K.load_if_empty(read(), load)
    return read().withColumns({"loaded_first": F.lit(first), "loaded_again": F.lit(again)})


@query("k8_create_table_as", "SELECT * FROM {orders} WHERE o_totalprice > 250000")
def _(t):
    return K.create_table_as(
        t.spark, _table_name("selected"), t.scratch("ctas"), "SELECT * FROM {orders} WHERE o_totalprice > 250000", orders=t.orders
    )


@query("k9_temp_view", "SELECT n_regionkey, count(*) AS nations FROM {nation} GROUP BY 1")
def _(t):
    view = _table_name("nations")
    K.register_view(t.nation, view)
    return t.spark.sql(f"SELECT n_regionkey, count(*) AS nations FROM {view} GROUP BY n_regionkey")


@query("k10_commented_view", "SELECT c_custkey, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
def _(t):
    customers, nations = _table_name("c"), _table_name("n")
    K.register_view(t.customer, customers)
    K.register_view(t.nation, nations)
    return K.commented_view(
        t.spark, _table_name("v"), "customers with nations",
        f"SELECT c_custkey, n_name FROM {customers} JOIN {nations} ON c_nationkey = n_nationkey",
    )


@query("k11_full_refresh", "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1")
def _(t):
    name, folder = _table_name("mv"), t.scratch("mv")
    build = lambda: t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    K.refresh(name, lambda: build().limit(1), folder)
    return K.refresh(name, build, folder)


@query(
    "k14_flagged_folders",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_totalprice < 50000 AS is_quarantined FROM {orders}",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    flagged = K.write_flagged(rows, t.scratch("flagged"), "is_quarantined", F.col("o_totalprice") < 50000)
    return flagged.filter("is_quarantined").union(flagged.filter("NOT is_quarantined"))


@query("k15_sorted_rewrite", "SELECT o_orderkey, o_orderdate FROM {orders}")
def _(t):
    return K.rewrite_sorted(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], t.scratch("sorted"))


@query(
    "k16_fan_out",
    r"SELECT o_orderkey, o_orderpriority, lower(regexp_replace(o_orderpriority, '[ \-]', '_', 'g')) AS part_of FROM {orders}",
)
def _(t):
    return K.fan_out(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", t.scratch("fan"))


# ---- versions: v0 the orders, v1 an update, v2 a delete, v3 a merge

_V = {
    0: "SELECT * FROM {orders}",
    1: "SELECT * REPLACE (CASE WHEN o_orderkey%11=0 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice) FROM v0",
    2: "SELECT * FROM v1 WHERE NOT coalesce(o_orderkey%17=0, false)",
    3: """SELECT * FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src""",
}
_SRC = """SELECT * REPLACE (CASE WHEN o_orderkey%34=0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey, o_totalprice * 2 AS o_totalprice)
  FROM {orders} WHERE o_orderstatus = 'P'"""
_VERSIONS = f"WITH v0 AS ({_V[0]}), v1 AS ({_V[1]}), v2 AS ({_V[2]}), src AS ({_SRC}), v3 AS ({_V[3]})"
_AT = [f"2024-05-0{d} 12:00:00" for d in range(1, 10)]


def _update(df):
    return V.update_where(df, F.col("o_orderkey") % 11 == 0, {"o_totalprice": F.col("o_totalprice") + 5})


def _delete(df):
    return V.delete_where(df, F.col("o_orderkey") % 17 == 0)


def _source(t) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.filter(F.col("o_orderstatus") == "P").withColumns(
        {"o_orderkey": F.when(key % 34 == 0, key + 10000000).otherwise(key), "o_totalprice": F.col("o_totalprice") * 2}
    )


def _history(t, versions=4):
    """The orders with up to four versions."""
    table = V.VersionedTable(t.spark, t.scratch("orders"))
    table.create(t.orders, _AT[0])
    if versions > 1:
        table.commit(_update(table.read()), "UPDATE", _AT[1])
    if versions > 2:
        table.commit(_delete(table.read()), "DELETE", _AT[2])
    if versions > 3:
        table.commit(V.merge(table.read(), _source(t), ["o_orderkey"]), "MERGE", _AT[3])
    return table


@query("m1_update_where", _VERSIONS + " SELECT * FROM v1")
def _(t):
    return _update(t.orders)


@query("m2_delete_where", "SELECT * FROM {orders} WHERE NOT coalesce(CASE WHEN o_custkey%5=0 THEN NULL ELSE o_orderkey%17=0 END, false)")
def _(t):
    condition = F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderkey") % 17 == 0)
    return V.delete_where(t.orders, condition)


@query("m3_insert", "SELECT * FROM {orders} UNION ALL SELECT o_orderkey + 20000000, o_custkey, 'N', o_totalprice, o_orderdate, NULL FROM {orders}")
def _(t):
    rows = t.orders.select(
        (F.col("o_orderkey") + 20000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_custkey", "o_orderdate"
    )
    return V.insert(t.orders, rows)


@query("m4_merge", _VERSIONS + " SELECT * FROM v3")
def _(t):
    return V.merge(_delete(_update(t.orders)), _source(t), ["o_orderkey"])


@query("m5_read_version", _VERSIONS + " SELECT * FROM v1")
def _(t):
    return _history(t, 3).read(1)


@query("m6_read_at_time", _VERSIONS + " SELECT * FROM v1")
def _(t):
    return _history(t, 3).read_at("2024-05-03 11:59:59")


def _states(t, last=3):
    """The orders and what update, delete and merge make of them, as plain frames."""
    states = {0: t.orders}
    steps = (_update, _delete, lambda df: V.merge(df, _source(t), ["o_orderkey"]))
    for n, step in enumerate(steps[:last], 1):
        states[n] = step(states[n - 1])
    return states


@query("m7_version_diff", _VERSIONS + " SELECT * FROM v1 EXCEPT ALL SELECT * FROM v0")
def _(t):
    states = _states(t, 1)
    return states[1].exceptAll(states[0])


@query("m7_version_diff_distinct", _VERSIONS + " SELECT * FROM v3 EXCEPT SELECT * FROM v1")
def _(t):
    states = _states(t)
    return states[3].subtract(states[1])


@query("m8_restore", _VERSIONS + " SELECT * FROM v0")
def _(t):
    table = _history(t, 2)
    table.restore(0, _AT[4])
    return table.read()


def _feed_sql(number, old, new):
    both = f"{old} a FULL JOIN {new} b ON a.o_orderkey = b.o_orderkey"
    differs = "(a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_totalprice IS DISTINCT FROM b.o_totalprice)"
    tail = f"{number} AS _commit_version, TIMESTAMP '{_AT[number]}' AS _commit_timestamp"
    return f"""SELECT a.*, CASE WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type, {tail} FROM {both} WHERE a.o_orderkey IS NOT NULL AND {differs}
    UNION ALL SELECT b.*, CASE WHEN a.o_orderkey IS NULL THEN 'insert' ELSE 'update_postimage' END, {tail} FROM {both} WHERE b.o_orderkey IS NOT NULL AND {differs}"""


@query("m9_change_feed", _VERSIONS + " " + " UNION ALL ".join(_feed_sql(n, f"v{n - 1}", f"v{n}") for n in (1, 2, 3)))
def _(t):
    return V.change_feed(_states(t), ["o_orderkey"], dict(enumerate(_AT)))


@query(
    "m10_version_log",
    _VERSIONS
    + " "
    + " UNION ALL ".join(
        f"SELECT {n} AS version, TIMESTAMP '{_AT[n]}' AS committed_at, '{op}' AS operation, (SELECT count(*) FROM v{n}) AS row_count"
        for n, op in enumerate(("CREATE", "UPDATE", "DELETE", "MERGE"))
    ),
)
def _(t):
    return _history(t).log()


@query(
    "m11_add_column",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS STRING) AS transaction_category FROM {supplier}
       UNION ALL SELECT s_suppkey + 1000, s_name, s_nationkey, s_acctbal, 'General' FROM {supplier}""",
)
def _(t):
    wider = V.add_column(t.supplier, "transaction_category", "string")
    new = t.supplier.withColumn("s_suppkey", F.col("s_suppkey") + 1000)
    return V.insert(wider, new, {"transaction_category": "General"})


@query("m12_compact", "SELECT l_orderkey, l_linenumber, l_quantity, true AS fewer_files FROM {lineitem}")
def _(t):
    table = V.VersionedTable(t.spark, t.scratch("lineitem"))
    table.create(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").repartition(24), _AT[0])
    counts = table.compact(128 * 1024 * 1024, _AT[1])
    return table.read().withColumn("fewer_files", F.lit(counts["after"] < counts["before"]))


@query("m13_clustered_layout", "SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, true AS few_by_first, true AS few_by_second FROM {lineitem}")
def _(t):
    """The rows, and whether a filter on either column leaves out a good part of the files, by their smallest and largest values."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    folder = t.scratch("clustered")
    V.clustered(rows, "l_suppkey", "l_shipdate", 8).write.parquet(folder)
    laid = t.spark.read.parquet(folder)
    touched = V.touched_shares(laid, ["l_suppkey", "l_shipdate"])
    few = lambda c: (touched.select(c).scalar() < 0.75)
    return laid.withColumns({"few_by_first": few("l_suppkey"), "few_by_second": few("l_shipdate")})
