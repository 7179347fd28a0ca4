"""Queries on change capture."""

from pyspark.sql import functions as F

from lakeloom.operators import history as H
from lakeloom.queries.base import query
from lakeloom.queries.inputs import SNAPSHOTS
from lakeloom.session import cut


def _history_sql(source, key, seq, tracked, plain, gaps=False):
    """Versions in SQL by lag, running sum and lead."""
    cols = ", ".join(plain)
    change = " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in tracked) or "false"
    gap = " OR lag(" + seq + ") OVER w IS DISTINCT FROM before" if gaps else ""
    calendar = (
        f", cal AS (SELECT {seq}, lag({seq}) OVER (ORDER BY {seq}) AS before, lead({seq}) OVER (ORDER BY {seq}) AS after"
        f" FROM (SELECT DISTINCT {seq} FROM src) x)"
        if gaps
        else ""
    )
    rows = "src JOIN cal USING ({})".format(seq) if gaps else "src"
    end = (
        "arg_max(after_or_null, {})".format(seq)
        if gaps
        else None
    )
    after = ", struct_pack(a := after) AS after_or_null" if gaps else ""
    closing = (
        f'({end}).a AS "__END_AT"'
        if gaps
        else f'lead(min({seq})) OVER (PARTITION BY {key} ORDER BY min({seq})) AS "__END_AT"'
    )
    values = ", ".join(f"(arg_max(struct_pack(a := {c}), {seq})).a AS {c}" for c in plain)
    return f"""src AS ({source}){calendar},
marked AS (SELECT *{after}, CASE WHEN row_number() OVER w = 1 OR {change}{gap} THEN 1 ELSE 0 END AS starts FROM {rows}
           WINDOW w AS (PARTITION BY {key} ORDER BY {seq})),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY {key} ORDER BY {seq}) AS run FROM marked),
hist AS (SELECT {key}, {values}, min({seq}) AS "__START_AT", {closing} FROM runs GROUP BY {key}, run)"""


_EVENTS = "SELECT user_id, ts, event_type, value, event_id FROM {events}"
_EVENT_HISTORY = _history_sql(_EVENTS, "user_id", "ts", ["event_type"], ["event_type", "value", "event_id"])
_HISTORY_COLUMNS = 'user_id, event_type, value, event_id, "__START_AT", "__END_AT"'


def _event_history(t):
    return H.scd2(
        t.events.select("user_id", "ts", "event_type", "value", "event_id"),
        ["user_id"],
        "ts",
        track_except=["value", "event_id"],
    )


@query(
    "d1_scd1",
    """SELECT user_id, ts, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM {events}) x WHERE rn = 1""",
)
def _(t):
    return H.scd1(
        t.events.select("user_id", "ts", "event_type", "value", "event_id"), ["user_id"], "ts", ["event_id"]
    )


@query("d2_scd2", f"WITH {_EVENT_HISTORY} SELECT {_HISTORY_COLUMNS} FROM hist")
def _(t):
    return _event_history(t)


@query(
    "w2_history_intervals",
    f"""WITH {_history_sql("SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM {orders}", "o_custkey", "o_orderkey", ["o_orderstatus"], ["o_orderstatus"])}
SELECT o_custkey, o_orderstatus, "__START_AT", "__END_AT" FROM hist""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return H.scd2(rows, ["o_custkey"], "o_orderkey")


@query(
    "d3_scd1_from_snapshots",
    f"WITH src AS ({SNAPSHOTS}) SELECT user_id, day, event_type, value FROM src WHERE day = (SELECT max(day) FROM src)",
)
def _(t):
    return H.scd1_from_snapshots(t.sql(SNAPSHOTS), "day")


_VERSIONED = f"SELECT user_id, event_type, value, CAST(year(day)*10000 + month(day)*100 + day(day) AS INT) AS version FROM ({SNAPSHOTS}) s"
_SNAPSHOT_HISTORY = _history_sql(_VERSIONED, "user_id", "version", ["event_type"], ["event_type", "value"], gaps=True)


@query(
    "d4_scd2_from_snapshots",
    f'WITH {_SNAPSHOT_HISTORY} SELECT user_id, event_type, value, "__START_AT", "__END_AT" FROM hist',
)
def _(t):
    # The snapshots are landed first, as a loader would leave them.
    snapshots = cut(t.sql(SNAPSHOTS))
    versioned = snapshots.withColumn("version", H.version_number(F.col("day"))).drop("day")
    return H.scd2_from_snapshots(versioned, ["user_id"], "version", track_except=["value"])


# The order days have no order on some dates; the first such date ends the sequence.
_ORDER_DAYS = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM {orders}"


@query(
    "d5_contiguous_snapshots",
    f"""WITH src AS ({_ORDER_DAYS}),
days AS (SELECT DISTINCT day FROM src WHERE day >= DATE '1995-03-01'),
stop AS (SELECT min(day) AS last FROM days WHERE day + 1 NOT IN (SELECT day FROM days))
SELECT src.* FROM src, stop WHERE day >= DATE '1995-03-01' AND day <= last""",
)
def _(t):
    return H.contiguous_snapshots(t.sql(_ORDER_DAYS), "day", "1995-03-01")


@query(
    "d6_scd2_deletes",
    f"""WITH {_EVENT_HISTORY} SELECT {_HISTORY_COLUMNS} FROM hist WHERE "__END_AT" IS NULL AND "__START_AT" <> (SELECT max("__START_AT") FROM hist)""",
)
def _(t):
    return H.deleted(cut(_event_history(t)))


@query(
    "d6_unseen_keys",
    f"""WITH {_history_sql("SELECT *, day AS loaded FROM (" + SNAPSHOTS + ") s", "user_id", "day", ["event_type"], ["event_type", "value", "loaded"])}
SELECT user_id, event_type, value, loaded, "__START_AT", "__END_AT" FROM hist WHERE "__END_AT" IS NULL AND loaded < (SELECT max(loaded) FROM hist)""",
)
def _(t):
    snapshots = t.sql(SNAPSHOTS).withColumn("loaded", F.col("day"))
    return H.unseen(cut(H.scd2(snapshots, ["user_id"], "day", ["value", "loaded"])), "loaded")


@query(
    "d7_scd2_active",
    f"""WITH {_EVENT_HISTORY} SELECT {_HISTORY_COLUMNS} FROM hist WHERE "__END_AT" IS NULL AND "__START_AT" = (SELECT max("__START_AT") FROM hist)""",
)
def _(t):
    return H.active(cut(_event_history(t)))


_DAY_HISTORY = _history_sql(SNAPSHOTS, "user_id", "day", ["event_type"], ["event_type", "value"])


@query(
    "d8_scd2_final",
    f"""WITH {_DAY_HISTORY},
live AS (SELECT * FROM hist WHERE "__END_AT" IS NULL AND "__START_AT" = (SELECT max("__START_AT") FROM hist)),
gone AS (SELECT * FROM hist WHERE "__END_AT" IS NULL AND "__START_AT" <> (SELECT max("__START_AT") FROM hist))
SELECT user_id, event_type, value, "__START_AT", "__END_AT" FROM live WHERE user_id NOT IN (SELECT user_id FROM gone)""",
)
def _(t):
    history = cut(H.scd2(t.sql(SNAPSHOTS), ["user_id"], "day", ["value"]))
    return H.final(H.active(history), H.deleted(history), ["user_id"])
