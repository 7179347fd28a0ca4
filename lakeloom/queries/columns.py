"""Projections, filters, scalar functions and former UDFs."""

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import text, times, units
from lakeloom.operators import filters, rows
from lakeloom.queries.base import query
from lakeloom.sinks.tables import save_table


@query(
    "p1_select_alias",
    """SELECT c_custkey AS customer, c_name AS label, c_acctbal AS balance, c_mktsegment AS segment,
       c_nationkey AS nation, c_acctbal < 0 AS overdrawn FROM {customer}""",
)
def _(t):
    renamed = t.customer.select(
        F.col("c_custkey").alias("customer"),
        F.col("c_name").alias("label"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    return renamed.select("*", (F.col("balance") < 0).alias("overdrawn"))


@query(
    "p2_add_rename_drop",
    """SELECT o_orderkey AS order_id, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
       upper(o_orderstatus) AS status_upper, 'EUR' AS currency FROM {orders}""",
)
def _(t):
    return (
        t.orders.withColumns({"status_upper": F.upper("o_orderstatus"), "currency": F.lit("EUR")})
        .withColumnsRenamed({"o_orderkey": "order_id", "no_such_column": "x"})
        .drop("o_orderstatus", "no_such_column")
    )


@query(
    "p3_underscore_names",
    """SELECT p_partkey AS part_key, p_name AS part_full_name, p_size AS size FROM {part}""",
)
def _(t):
    spaced = t.part.select(
        F.col("p_partkey").alias("part key"),
        F.col("p_name").alias("part full name"),
        F.col("p_size").alias("size"),
    )
    return text.underscore_names(spaced)


_MIXED = "concat(p_name, ' (', p_type, ') [', p_brand, '] ', p_partkey, '%')"


@query(
    "p4_identifier",
    r"""SELECT p_partkey, lower(regexp_replace(concat(p_name, ' (', p_type, ') [', p_brand, '] ', p_partkey, '%'),
       '[ \-''.,;:!?()\[\]{}/\\|&@#%+=$^~]', '_', 'g')) AS table_suffix FROM {part}""",
)
def _(t):
    return t.part.select("p_partkey", text.identifier(F.expr(_MIXED)).alias("table_suffix"))


@query(
    "p5_email_user",
    """SELECT c_custkey, CASE WHEN c_custkey%5=0 THEN NULL
         ELSE regexp_replace(concat(lower(c_mktsegment), '.', lower(replace(c_name, '#', '_'))), '[._]', '_', 'g') END AS user_name
       FROM {customer}""",
)
def _(t):
    user = "concat(lower(c_mktsegment), '.', lower(replace(c_name, '#', '_')))"
    email = F.expr(f"{user} || CASE WHEN c_custkey%5=0 THEN '' ELSE '@example.com' END")
    return t.customer.select("c_custkey", text.email_user(email).alias("user_name"))


def _nested(t):
    """Order lines as nested records: prices in structs, flags in an array, marks in a map."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.struct(F.col("l_extendedprice").alias("usd"), (F.col("l_extendedprice") * 2).alias("chf")).alias("price"),
            F.struct(F.col("l_tax").alias("usd")).alias("tax"),
        ).alias("market_data"),
        F.when(
            F.col("l_linenumber") > 1,
            F.array(
                F.struct(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty")),
                F.struct(F.col("l_linestatus").alias("flag"), F.col("l_discount").alias("qty")),
            ),
        ).otherwise(F.array().cast("array<struct<flag:string,qty:double>>")).alias("marks"),
        F.create_map(F.lit("state"), F.col("l_linestatus"), F.lit("country"), F.col("l_returnflag")).alias("response"),
    )


@query(
    "p6_struct_paths",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS price_usd, l_extendedprice*2 AS price_chf, l_tax AS tax_usd
       FROM {lineitem}""",
)
def _(t):
    return _nested(t).select(
        "l_orderkey",
        "l_linenumber",
        F.col("market_data.price.usd").alias("price_usd"),
        F.col("market_data.price.chf").alias("price_chf"),
        F.col("market_data.tax.usd").alias("tax_usd"),
    )


@query(
    "p7_array_element",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber>1 THEN l_returnflag END AS first_flag,
       CASE WHEN l_linenumber>1 THEN l_discount END AS second_qty FROM {lineitem}""",
)
def _(t):
    return _nested(t).select(
        "l_orderkey",
        "l_linenumber",
        F.get("marks", F.lit(0))["flag"].alias("first_flag"),
        F.get("marks", F.lit(1))["qty"].alias("second_qty"),
    )


@query(
    "p8_map_value",
    """SELECT l_orderkey, l_linenumber, l_linestatus AS state, l_returnflag AS country,
       CAST(NULL AS STRING) AS zone FROM {lineitem}""",
)
def _(t):
    return _nested(t).select(
        "l_orderkey",
        "l_linenumber",
        F.try_element_at("response", F.lit("state")).alias("state"),
        F.try_element_at("response", F.lit("country")).alias("country"),
        F.try_element_at("response", F.lit("zone")).alias("zone"),
    )


@query(
    "p9_cast",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day_start, CAST(o_orderkey AS STRING) AS key_text,
       CAST(floor(o_totalprice) AS BIGINT) AS price_floor, CAST(NULL AS BOOLEAN) AS flag, o_orderpriority AS body
       FROM {orders}""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").cast("timestamp").alias("day_start"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("bigint").alias("price_floor"),
        F.lit(None).cast("boolean").alias("flag"),
        F.col("o_orderpriority").cast("binary").cast("string").alias("body"),
    )


@query("p10_cast_ntz", "SELECT event_id, ts, user_id, event_type, value, props FROM {events}")
def _(t):
    return rows.cast_ntz_to_timestamp(t.events)


@query(
    "p11_case",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
       CASE WHEN o_totalprice > 400000 THEN o_totalprice * 0.9 ELSE o_totalprice END AS price FROM {orders}""",
)
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "filled").when(status == "O", "open").otherwise("pending").alias("status"),
        F.when(F.col("o_totalprice") > 400000, F.col("o_totalprice") * 0.9)
        .otherwise(F.col("o_totalprice"))
        .alias("price"),
    )


@query(
    "p12_translate",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Bau' WHEN 'MACHINERY' THEN 'Maschinen'
       WHEN 'HOUSEHOLD' THEN 'Haushalt' END AS segment_de FROM {customer}""",
)
def _(t):
    names = {"BUILDING": "Bau", "MACHINERY": "Maschinen", "HOUSEHOLD": "Haushalt"}
    return t.customer.select(
        "c_custkey", text.translate_by(F.col("c_mktsegment"), names).alias("segment_de")
    )


@query(
    "p13_classify",
    """SELECT doc_id, CASE WHEN text LIKE '%salary%' OR text LIKE '%Salary%' THEN 'Payroll'
       WHEN text LIKE '%training%' OR text LIKE '%Training%' THEN 'Education'
       WHEN text LIKE '%office%' OR text LIKE '%Office%' THEN 'Office Expenses' ELSE 'General' END AS category,
       CASE WHEN text LIKE '%License%' OR text LIKE '%license%' THEN 'license' WHEN text LIKE '%@%' THEN 'contact' ELSE 'prose' END AS kind
       FROM {documents}""",
)
def _(t):
    kinds = {"license": ("%License%", "%license%"), "contact": ("%@%",)}
    return t.documents.select(
        "doc_id",
        text.classify(F.col("text"), text.PAYMENT_CATEGORIES, "General").alias("category"),
        text.classify(F.col("text"), kinds, "prose").alias("kind"),
    )


@query(
    "p14_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}
       WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_shipdate = (TIMESTAMP '1998-03-05 00:00:00')""",
)
def _(t):
    return t.lineitem.filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.col("l_shipdate") == F.lit("1998-03-05 00:00:00").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "p15_null_checks",
    """SELECT d.doc_id, quality, toxic FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
       WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").na.drop()


@query(
    "p16_like",
    """SELECT page_id, url, url LIKE '%e_ample.com/%' AS wild, starts_with(url, 'http://t') AS strict
       FROM {pages} WHERE url LIKE 'http_%' AND url NOT LIKE '%page=2%'""",
)
def _(t):
    url = F.col("url")
    return t.pages.filter(url.like("http_%") & ~url.like("%page=2%")).select(
        "page_id", "url", url.like("%e_ample.com/%").alias("wild"), url.startswith("http://t").alias("strict")
    )


@query(
    "p17_prefix_substring",
    """SELECT p_partkey, p_name FROM {part} WHERE starts_with(p_type, 'ECO') AND contains(lower(p_name), 'ring')""",
)
def _(t):
    return t.part.filter(
        F.col("p_type").startswith("ECO") & F.lower("p_name").contains("ring")
    ).select("p_partkey", "p_name")


@query(
    "p18_between",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem} WHERE l_quantity BETWEEN 10 AND 12",
)
def _(t):
    return t.lineitem.filter(F.col("l_quantity").between(10, 12)).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "p19_in_list",
    "SELECT event_id, user_id FROM {events} WHERE event_type IN ('signup', 'purchase')",
)
def _(t):
    return t.events.filter(F.col("event_type").isin("signup", "purchase")).select("event_id", "user_id")


@query(
    "p20_in_subquery",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
       WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')""",
)
def _(t):
    builders = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return filters.rows_in(t.orders, builders, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "p21_latest_of_target",
    """SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderpriority = '1-URGENT'
       AND o_orderdate = (SELECT max(o_orderdate) FROM {orders} WHERE o_orderpriority = '1-URGENT')""",
)
def _(t):
    return filters.newest_of_group(t.orders, "o_orderpriority", "1-URGENT", "o_orderdate").select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "p22_global_max",
    """SELECT o_orderkey, true AS is_newest FROM {orders} WHERE o_orderdate = (SELECT max(o_orderdate) FROM {orders})
       UNION ALL
       SELECT o_orderkey, false FROM {orders} WHERE o_orderdate <> (SELECT max(o_orderdate) FROM {orders})""",
)
def _(t):
    newest = rows.equals_global_max(t.orders, "o_orderdate")
    older = rows.equals_global_max(t.orders, "o_orderdate", equal=False)
    return newest.select("o_orderkey", F.lit(True).alias("is_newest")).unionAll(
        older.select("o_orderkey", F.lit(False).alias("is_newest"))
    )


def _audited(t):
    return t.supplier.withColumns(
        {"_rescued_data": F.lit(None).cast("string"), "FilePath": F.lit("x"), "LoadTimestamp": F.lit("y")}
    )


@query(
    "p23_drop_audit",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {supplier}",
)
def _(t):
    return filters.without_audit_columns(_audited(t))


@query("p24_exclude_columns", "SELECT s_suppkey, s_name FROM {supplier}")
def _(t):
    return filters.without_audit_columns(_audited(t), exclude=["s_nationkey", "s_acctbal"])


@query(
    "p25_audit_columns",
    """SELECT event_id, '2024-02-01T00:00:00+00:00' AS load_timestamp, 'load-1' AS load_id, 'sensors' AS source_system,
       'ingest' AS pipeline_name, 'loader' AS run_as FROM {events}""",
)
def _(t):
    return filters.with_audit_columns(
        t.events.select("event_id"), "load-1", "2024-02-01T00:00:00+00:00", "sensors", "ingest", "loader"
    )


@query(
    "p26_name_parts",
    """SELECT l_orderkey, l_linenumber, 'c' || l_suppkey%3 AS catalog,
       CASE WHEN l_linenumber > 1 THEN l_returnflag END AS schema,
       CASE WHEN l_linenumber > 2 THEN 't' || l_partkey END AS "table" FROM {lineitem}""",
)
def _(t):
    name = F.expr(
        """CASE WHEN l_linenumber > 2 THEN concat('c', l_suppkey%3, '.', l_returnflag, '.t', l_partkey)
           WHEN l_linenumber = 2 THEN concat('c', l_suppkey%3, '.', l_returnflag)
           ELSE concat('c', l_suppkey%3) END"""
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", *text.name_parts(name))


@query(
    "p27_arithmetic",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
       l_orderkey * 10 + l_linenumber AS line_id FROM {lineitem}""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
    )


@query(
    "p28_missing_columns",
    """SELECT s_suppkey, s_name, CAST(NULL AS STRING) AS s_phone, CAST(NULL AS DATE) AS s_since FROM {supplier}""",
)
def _(t):
    wanted = T.StructType.fromDDL("s_suppkey bigint, s_name string, s_phone string, s_since date")
    return rows.with_columns_of(t.supplier, wanted)


@query(
    "p29_parameterised_sql",
    """SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
)
def _(t):
    return filters.parameterised(
        t.spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice > :least",
        {"status": "F", "least": 100000.0},
        orders=t.orders,
    )


@query(
    "p29_table_name_parameter",
    """SELECT o_orderstatus, count(*) AS n, sum(CAST(o_orderkey AS BIGINT))::BIGINT AS keys FROM {orders} WHERE o_totalprice > 100000 GROUP BY 1""",
)
def _(t):
    """The table itself is an argument: its name goes through IDENTIFIER, so no text is put together."""
    name = f"orders_{uuid4().hex[:12]}"
    save_table(t.orders, name, path=t.scratch("orders"))
    select = "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey) AS keys FROM IDENTIFIER(:table) WHERE o_totalprice > :least GROUP BY o_orderstatus"
    return filters.parameterised(t.spark, select, {"table": name, "least": 100000.0})


@query(
    "f1_string_functions",
    """SELECT p_partkey, concat(p_name, '/', p_brand) AS joined, concat_ws('||', p_name, p_brand, p_type) AS listed,
       split_part(p_name, ' ', 1) AS first_word, lower(p_brand) AS lowered, contains(lower(p_name), 'red') AS has_red,
       replace(p_brand, '#', '_') AS replaced, split_part(p_brand, '#', -1) AS tail FROM {part}""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit("/"), "p_brand").alias("joined"),
        F.concat_ws("||", "p_name", "p_brand", "p_type").alias("listed"),
        F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
        F.lower("p_brand").alias("lowered"),
        F.lower("p_name").contains("red").alias("has_red"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("replaced"),
        F.substring_index("p_brand", "#", -1).alias("tail"),
    )


@query(
    "f2_regex_extract",
    r"""SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS digits, CASE WHEN user_id%2=0 THEN date_trunc('second', ts) END AS zulu,
       CAST(user_id AS STRING) AS host_id FROM {events}""",
)
def _(t):
    name = F.concat(F.lit("customer_snapshot_"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit(".parquet"))
    zulu = F.when(
        F.col("user_id") % 2 == 0,
        F.concat(F.lit("/in/m_"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit(".parquet")),
    ).otherwise("/in/none.parquet")
    host = F.concat(F.lit("https://ws-"), "user_id", F.lit(".12.example.net/"))
    return t.events.select(
        "event_id",
        F.regexp_extract(name, times.COMPACT_STAMP[0], 1).alias("digits"),
        times.stamp_in(zulu, *times.ZULU_STAMP).alias("zulu"),
        F.regexp_extract(host, r"https://ws-(\d+)\.\d+\.example\.net/", 1).alias("host_id"),
    )


@query(
    "f3_sha256",
    "SELECT doc_id, sha256(concat_ws('||', text, lang, source)) AS hash_key FROM {documents}",
)
def _(t):
    return t.documents.select(
        "doc_id", text.hash_key(F.col("text"), F.col("lang"), F.col("source")).alias("hash_key")
    )


@query(
    "f4_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS INT) AS k_number,
       json_extract_string(props, '$.none') AS absent FROM {events}""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k INT")["k"].alias("k_number"),
        F.get_json_object("props", "$.none").alias("absent"),
    )


@query(
    "f5_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q, CAST(month(o_orderdate) AS INT) AS m,
       CAST(day(o_orderdate) AS INT) AS d, CAST(dayofyear(o_orderdate) AS INT) AS doy, CAST(weekofyear(o_orderdate) AS INT) AS week,
       CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow_us, CAST(isodow(o_orderdate) AS INT) AS dow_iso FROM {orders}""",
)
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.dayofmonth(d).alias("d"),
        F.dayofyear(d).alias("doy"),
        F.extract(F.lit("WEEKS"), d).alias("week"),
        F.extract(F.lit("DOW"), d).alias("dow_us"),
        F.extract(F.lit("DOW_ISO"), d).alias("dow_iso"),
    )


@query(
    "f6_date_arithmetic",
    """SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 DAY AS DATE) AS before,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 4 DAY AS DATE) AS after,
       make_date(1972, month(o_orderdate), day(o_orderdate)) AS month_day FROM {orders}""",
)
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.last_day(d).alias("month_end"),
        F.date_sub(d, 3).alias("before"),
        F.date_add(d, 4).alias("after"),
        F.make_date(F.lit(1972), F.month(d), F.dayofmonth(d)).alias("month_day"),
    )


@query(
    "f7_date_format",
    """SELECT event_id, strftime(ts, '%d.%m.%Y') AS day_text, CAST(strftime(ts, '%Y%m') AS INT) AS month_id, strftime(ts, '%B') AS month_name,
       strftime(ts, '%b') AS month_short, strftime(ts, '%A') AS day_name, strftime(ts, '%a') AS day_short,
       strftime(ts, '%H:%M:%S') AS clock, strftime(ts, '%p') AS half, date_trunc('second', ts) AS parsed, CAST(ts AS DATE) AS day FROM {events}""",
)
def _(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.date_format(ts, "dd.MM.yyyy").alias("day_text"),
        F.date_format(ts, "yyyyMM").cast("int").alias("month_id"),
        F.date_format(ts, "MMMM").alias("month_name"),
        F.date_format(ts, "MMM").alias("month_short"),
        F.date_format(ts, "EEEE").alias("day_name"),
        F.date_format(ts, "EEE").alias("day_short"),
        F.date_format(ts, "HH:mm:ss").alias("clock"),
        F.date_format(ts, "a").alias("half"),
        F.to_timestamp(F.date_format(ts, "yyyyMMddHHmmss"), "yyyyMMddHHmmss").alias("parsed"),
        F.to_date(ts).alias("day"),
    )


@query(
    "f8_epoch",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, date_trunc('second', ts) AS back,
       CAST(floor(epoch(ts)) AS BIGINT) % 86400 AS day_seconds, CAST(ts AS DATE) AS day FROM {events}""",
)
def _(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", seconds.alias("seconds")).select(
        "event_id",
        "seconds",
        F.timestamp_seconds("seconds").alias("back"),
        times.day_seconds(F.col("seconds")).alias("day_seconds"),
        times.epoch_date(F.col("seconds")).alias("day"),
    )


@query(
    "f9_time_parts",
    """SELECT event_id, CAST(hour(ts) AS INT) AS h, CAST(minute(ts) AS INT) AS m, CAST(second(ts) AS INT) AS s FROM {events}""",
)
def _(t):
    return t.events.select(
        "event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"), F.second("ts").alias("s")
    )


@query(
    "f10_truncation",
    """SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, date_trunc('hour', ts) AS hour_start, CAST(ts AS DATE) AS day FROM {events}""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.date_trunc("month", "ts").alias("month_start"),
        F.date_trunc("hour", "ts").alias("hour_start"),
        F.to_date("ts").alias("day"),
    )


@query(
    "f11_math",
    """SELECT l_orderkey, l_linenumber, CAST(ceil(l_quantity / 7) AS BIGINT) AS packs, l_partkey % 60 AS rest,
       l_partkey / 86400.0 AS days FROM {lineitem}""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.ceil(F.col("l_quantity") / 7).alias("packs"),
        (F.col("l_partkey") % 60).alias("rest"),
        (F.col("l_partkey") / F.lit(86400.0)).alias("days"),
    )


@query(
    "f12_sequence_explode",
    """SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + INTERVAL (o_custkey % 4) DAY, INTERVAL 1 DAY)) AS DATE) AS day
       FROM {orders}""",
)
def _(t):
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_custkey") % 4).cast("int"))
    return t.orders.select("o_orderkey", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day"))


@query(
    "f13_clock_user",
    """SELECT event_id, TIMESTAMP '2024-02-01 06:00:00' AS load_time, 'loader' AS load_user,
       CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INT) AS age_days FROM {events}""",
)
def _(t):
    now, user = F.lit("2024-02-01 06:00:00").cast("timestamp"), F.lit("loader")
    return t.events.select(
        "event_id",
        now.alias("load_time"),
        user.alias("load_user"),
        F.datediff(F.to_date(now), F.to_date("ts")).alias("age_days"),
    )


_SIZES = (5, 10, 15, 20, 30, 60)


@query(
    "x1_window_label",
    "SELECT event_id, "
    + ", ".join(
        f"""lpad(CAST(minute(ts)//{d}*{d} AS STRING), 2, '0') || '-' || lpad(CAST(minute(ts)//{d}*{d}+{d} AS STRING), 2, '0') AS w{d}"""
        for d in _SIZES
    )
    + " FROM {events}",
)
def _(t):
    return t.events.select(
        "event_id", *[times.window_label(F.minute("ts"), d).alias(f"w{d}") for d in _SIZES]
    )


@query(
    "x2_cron_text",
    """SELECT event_id, CASE user_id%5 WHEN 4 THEN NULL ELSE concat('At ', hour(ts), ':', minute(ts), ':', second(ts),
       CASE user_id%5 WHEN 0 THEN ' every day' WHEN 1 THEN ' on every MON' WHEN 2 THEN concat(' on day ', day(ts), ' of the month') ELSE '' END) END AS readable
       FROM {events}""",
)
def _(t):
    cron = F.expr(
        """CASE user_id%5 WHEN 4 THEN CAST(NULL AS STRING) ELSE concat(second(ts), ' ', minute(ts), ' ', hour(ts), ' ',
           CASE user_id%5 WHEN 0 THEN '* * ?' WHEN 1 THEN '* * MON' WHEN 2 THEN concat(day(ts), ' * ?') ELSE '1 * MON' END) END"""
    )
    return t.events.select("event_id", text.cron_text(cron).alias("readable"))


@query(
    "x3_miles_to_km",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity * 1.60934::DOUBLE AS FLOAT) AS km FROM {lineitem}",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", units.miles_to_km(F.col("l_quantity")).alias("km")
    )
