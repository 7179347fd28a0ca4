"""Change capture: current state and history from sequenced rows or from full snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.rows import as_number, equals_global_max, newest, rank_among
from lakeloom.session import cut

START, END = "__START_AT", "__END_AT"
# Sequence of the newest row of a version; kept where later rows are to be spliced in.
LAST = "__LAST_AT"


def scd1(
    rows: DataFrame, keys: Sequence[str], sequence_by: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the largest sequence value per key; ``ties`` decide between equal values."""
    return newest(rows, keys, [F.col(c).desc() for c in (sequence_by, *ties)])


# Pieces that a sequence is cut into at most, and the rows that a piece is worth.
PIECES, PIECE_ROWS = 128, 1 << 16


def default_chunk(rows: DataFrame, sequence_by: str, pieces: int = PIECES, piece_rows: int = 1) -> Column:
    """Order-keeping piece of the sequence, with about as many rows in each: the place among approximate quantiles.

    The widths come from the data, so neither dense nor sparse sequences make one huge or very many pieces; there are no more
    pieces than ``piece_rows`` allow.
    """
    cuts = [i / pieces for i in range(1, pieces)]
    found = rows.agg(F.percentile_approx(as_number(rows, sequence_by), cuts, 16 * pieces), F.count(F.lit(1))).first()
    step = max(1, pieces // max(1, -(-found[1] // piece_rows)))
    return rank_among("_sequence", (found[0] or [])[step - 1 :: step])


def _refused(why: str) -> Column:
    return F.raise_error(F.lit(why)).cast("boolean")


def scd2(
    rows: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track_except: Sequence[str] = (),
    chunk: Column | None = None,
    ties: Sequence[str] = (),
    with_last: bool = False,
) -> DataFrame:
    """Versions of each key: a new one starts where a tracked column changes.

    A version ends where the next one starts; absence does not close it. Columns that are not
    tracked hold the newest value of the version. Of rows with equal key and sequence the one with the largest
    ``ties`` counts; without ``ties`` such rows fail the job.

    A key with few rows is worked on as a whole, in one sort of its rows. One with more than ``PIECE_ROWS`` or a null sequence, or
    every key if ``chunk`` is given, goes in pieces, by default up to 128 with about equally many rows of those keys, so that no task holds a
    long key. ``chunk`` must not decrease along the sequence; without it the sequence is a number, date or time, if there are
    such keys. ``with_last`` adds the sequence of each version's newest row.
    """
    keys = list(keys)
    if ties:
        rows = newest(rows, [*keys, sequence_by], [F.col(c).desc() for c in ties])
    if chunk is not None:
        return _versions_by_piece(rows, keys, sequence_by, track_except, chunk, with_last)
    as_number(rows, sequence_by)  # refuses what pieces cannot be made of, whatever the rows
    key, size = F.struct(*[F.col(f"`{k}`") for k in keys]), F.count(F.lit(1))
    sizes = rows.groupBy(key.alias("_long")).agg(size.alias("_n"), F.count(F.col(sequence_by)).alias("_placed"))
    long = cut(sizes.filter((F.col("_n") > PIECE_ROWS) | (F.col("_placed") < F.col("_n"))).select("_long"), "long")
    # Rows are dealt by key and kind of key; the kind comes with the short list of long keys.
    dealt = rows.join(long, key == F.col("_long"), "left").withColumn("_piece", F.when(F.col("_long").isNull(), 0).otherwise(1))
    if long.isEmpty():
        return _versions_by_key(dealt, rows.columns, keys, sequence_by, track_except, with_last)
    short = _versions_by_key(dealt.filter("_piece = 0"), rows.columns, keys, sequence_by, track_except, with_last)
    pieced = dealt.filter("_piece = 1").drop("_long", "_piece")
    return short.union(_versions_by_piece(pieced, keys, sequence_by, track_except, None, with_last))


def _versions_by_key(
    rows: DataFrame, columns: Sequence[str], keys: Sequence[str], sequence_by: str, track_except: Sequence[str], with_last: bool
) -> DataFrame:
    """:func:`scd2` of keys with one ``_piece``, all rows of a key in one task: the newest row of each version speaks for it."""
    plain = [c for c in columns if c not in keys and c != sequence_by]
    tracked = [c for c in plain if c not in track_except] or [sequence_by]
    seq, state = F.col(sequence_by), F.struct(*tracked)
    along = Window.partitionBy(*keys, "_piece").orderBy(seq)
    starts = (
        F.when(F.lag(F.lit(True)).over(along).isNull(), True)
        .when(F.lag(seq).over(along) == seq, _refused("a key has two rows with one sequence value"))
        .otherwise(~F.lag(state).over(along).eqNullSafe(state))
    )
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    versioned = rows.withColumn("_starts", starts).select(
        "*",
        F.last(F.when(F.col("_starts"), seq), ignorenulls=True).over(so_far).alias("_version"),
        F.coalesce(F.lead("_starts").over(along), F.lit(True)).alias("_newest"),
        F.lead(seq).over(along).alias("_following"),
    )
    return versioned.filter("_newest").select(
        *keys, *plain, F.col("_version").alias(START), F.col("_following").alias(END), *[seq.alias(LAST)] * with_last
    )


def _versions_by_piece(
    rows: DataFrame, keys: Sequence[str], sequence_by: str, track_except: Sequence[str], chunk: Column | None, with_last: bool
) -> DataFrame:
    """:func:`scd2` with a key's rows in pieces.

    Changes are found inside (key, chunk) groups; one row per group then tells each chunk how the one before it ended;
    versions are put together by an aggregation that works inside every task first.
    """
    plain = [c for c in rows.columns if c not in keys and c != sequence_by]
    tracked = [c for c in plain if c not in track_except] or [sequence_by]
    seq = F.col(sequence_by)
    kind = rows.schema[sequence_by].dataType
    state = F.struct(*tracked)
    if chunk is None:
        piece = default_chunk(rows, sequence_by, piece_rows=PIECE_ROWS)
        chunked = rows.withColumn("_sequence", as_number(rows, sequence_by)).withColumn("_chunk", piece).drop("_sequence")
    else:
        chunked = rows.withColumn("_chunk", chunk)
    # One struct as key: NULL parts match, and windows, aggregation and join share one partitioning.
    chunked = chunked.withColumn("_group", F.struct(*keys, "_chunk")).drop("_chunk")
    local = Window.partitionBy("_group").orderBy(seq)
    marked = chunked.select(
        "*",
        F.lag(F.lit(True)).over(local).isNull().alias("_first"),
        F.when(F.lag(seq).over(local) == seq, _refused("a key has two rows with one sequence value"))
        .otherwise(~F.lag(state).over(local).eqNullSafe(state))
        .alias("_differs"),
    )

    # One row per (key, chunk): how it begins, how it ends, where its last change is.
    ends = marked.groupBy("_group").agg(
        F.min_by(state, seq).alias("_head"),
        F.max_by(state, seq).alias("_tail"),
        F.min(seq).alias("_from"),
        F.max(F.when(F.col("_differs") & ~F.col("_first"), seq)).alias("_changed"),
    )
    key_columns = [f"_k{i}" for i in range(len(keys))]
    ends = ends.select(
        "*",
        *[F.col(f"_group.`{k}`").alias(c) for k, c in zip(keys, key_columns)],
        F.col("_group._chunk").alias("_chunk"),
    )
    along = Window.partitionBy(*key_columns).orderBy("_chunk")
    opened = ends.select(
        "_group",
        *key_columns,
        "_chunk",
        "_from",
        "_changed",
        (~F.lag("_tail").over(along).eqNullSafe(F.col("_head"))
         | F.lag(F.lit(True)).over(along).isNull()).alias("_opens"),
    )
    last_start = F.coalesce("_changed", F.when(F.col("_opens"), F.col("_from")))
    carried = opened.select(
        F.col("_group").alias("_same"),
        "_opens",
        F.last(last_start, ignorenulls=True)
        .over(along.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_open_version"),
    )
    joined = marked.join(carried, F.col("_group") == F.col("_same"))

    starts = F.when(F.col("_first"), F.col("_opens")).otherwise(F.col("_differs"))
    last_start_here = F.last(F.when(F.col("_starts"), seq), ignorenulls=True).over(
        local.rowsBetween(Window.unboundedPreceding, 0)
    )
    versioned = joined.withColumn("_starts", starts).select(
        "*",
        F.coalesce(last_start_here, F.col("_open_version")).alias("_version"),
        F.lead("_starts").over(local).alias("_before_start"),
        F.lead(seq).over(local).alias("_following"),
    )

    # The newest row of a version in its chunk speaks for the version; if another row follows in the
    # chunk, that row starts the next version and so ends this one. A version that ends where a chunk
    # begins learns it from the chunk's first row.
    newest_here = F.coalesce(F.col("_before_start"), F.lit(True))
    closes = F.col("_first") & F.col("_starts") & F.col("_open_version").isNotNull()
    payload = F.struct(*plain)
    payload_type = rows.select(payload).schema[0].dataType
    own = F.struct(
        F.col("_version").alias("v"), seq.alias("s"), F.col("_following").alias("e"), payload.alias("p")
    )
    closing = F.struct(
        F.col("_open_version").alias("v"),
        F.lit(None).cast(kind).alias("s"),
        seq.alias("e"),
        F.lit(None).cast(payload_type).alias("p"),
    )
    notes = F.array_compact(F.array(F.when(newest_here, own), F.when(closes, closing)))
    noted = versioned.filter(newest_here | closes).select(*keys, F.explode(notes).alias("_n"))
    return (
        noted.groupBy(*keys, F.col("_n.v").alias(START))
        .agg(F.max_by("_n.p", "_n.s").alias("_payload"), F.max("_n.e").alias(END), F.max("_n.s").alias(LAST))
        .select(*keys, *[F.col(f"_payload.`{c}`").alias(c) for c in plain], START, END, *[LAST] * with_last)
    )


def splice(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track_except: Sequence[str] = (),
    seen: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """The history after a batch of change rows, equal to :func:`scd2` over all rows, late and repeated ones included.

    ``history`` has the column ``LAST`` (``scd2(..., with_last=True)``), and so has the result. A key whose new rows all come
    after its newest one needs its open version only. For other keys the versions from the one that holds the first new row
    to the one after the last are built anew, from the rows of their time alone: ``seen`` gives all rows of earlier batches
    and is called only if there are such keys. Versions outside are passed on as they are.
    """
    keys = list(keys)
    key, seq = F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), F.col(f"`{sequence_by}`")
    columns = [c for c in batch.columns if c != sequence_by]
    fresh = cut(batch.distinct(), "fresh")
    spans = fresh.groupBy(key).agg(F.min(seq).alias("_lo"), F.max(seq).alias("_hi"))
    held = history.withColumn("_key", key)
    start, last = F.col(START), F.col(LAST)
    bounds = held.join(spans, "_key").groupBy("_key", "_lo", "_hi").agg(
        F.max(F.when(start <= F.col("_lo"), start)).alias("_from"),
        F.min(F.when(start > F.col("_hi"), start)).alias("_next"),
        F.max(last).alias("_newest"),
    )
    bounds = bounds.select("_key", "_from", "_next", (F.col("_lo") <= F.col("_newest")).alias("_late"))
    met = cut(held.join(bounds, "_key", "left"), "met")
    inside = F.col("_late").isNotNull() & (F.col("_from").isNull() | (start >= F.col("_from"))) & (F.col("_next").isNull() | (start <= F.col("_next")))
    windows = met.filter(inside)
    # An open version stands for its rows where all new ones come later.
    open_rows = windows.filter("not _late").select(*columns, start.alias(sequence_by))
    # The session of the history plans what follows: a stream's own has no adaptive execution.
    rows = open_rows.unionByName(fresh)
    late = windows.filter("_late").groupBy("_key").agg(F.first("_from").alias("_from"), F.max(F.struct(start.alias("s"), F.col(END).alias("e")))["e"].alias("_to"))
    late = cut(late, "late")
    if not late.isEmpty():
        if seen is None:
            raise ValueError("rows come late and the earlier ones are not given")
        again = seen().withColumn("_key", key).join(late, "_key")
        again = again.filter((F.col("_from").isNull() | (seq >= F.col("_from"))) & (F.col("_to").isNull() | (seq < F.col("_to"))))
        rows = rows.unionByName(again.select(*[F.col(f"`{c}`") for c in fresh.columns])).distinct()
    built = scd2(cut(rows, "rows"), keys, sequence_by, track_except, with_last=True).withColumn("_key", key)
    carried = windows.filter("not _late").select("_key", F.col(START).alias("_start"), F.col(LAST).alias("_last"))
    built = built.join(late.select("_key", "_to"), "_key", "left").join(carried, "_key", "left")
    ended = F.coalesce(F.col(END), F.col("_to")).alias(END)
    newest_row = F.when(start == F.col("_start"), F.greatest(last, F.col("_last"))).otherwise(last).alias(LAST)
    plain = [c for c in columns if c not in keys]
    return met.filter(~inside).select(*keys, *plain, START, END, LAST).union(built.select(*keys, *plain, START, ended, newest_row))


def contiguous_snapshots(
    snapshots: DataFrame, version: str, start: object | None = None, on_gap: str = "stop"
) -> DataFrame:
    """Snapshots from ``start`` (default: the first) in daily order; a missing day ends them.

    ``on_gap="skip"`` keeps all snapshots from ``start`` on.
    """
    day = F.col(version)
    begin = snapshots.agg(F.min(version)).first()[0] if start is None else start
    kept = snapshots.filter(day >= F.lit(begin).cast("date"))
    if on_gap == "skip":
        return kept
    if on_gap != "stop":
        raise ValueError("on_gap is 'stop' or 'skip'")
    days = kept.select(day.alias("_day")).distinct()
    following = days.select(F.date_sub("_day", 1).alias("_day"))
    last = days.join(following, "_day", "left_anti").agg(F.min("_day")).scalar()
    # A missing first day leaves nothing.
    has_begin = days.agg(F.min("_day")).scalar() == F.lit(begin).cast("date")
    return kept.filter((day <= last) & has_begin)


def version_number(day: Column) -> Column:
    """Snapshot version ``yyyymmdd`` of a date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def scd1_from_snapshots(snapshots: DataFrame, version: str) -> DataFrame:
    """The rows of the last snapshot; keys it lacks are gone."""
    return equals_global_max(snapshots, version)


def scd2_from_snapshots(
    snapshots: DataFrame, keys: Sequence[str], version: str, track_except: Sequence[str] = ()
) -> DataFrame:
    """History from full snapshots: absence closes a version at the first snapshot without the key.

    A key that comes back opens a new version. A key has one row per snapshot, so a key's group is
    no longer than the list of snapshots; a key twice in a snapshot fails the job.
    """
    keys = list(keys)
    plain = [c for c in snapshots.columns if c not in keys and c != version]
    tracked = [c for c in plain if c not in track_except]
    state = F.struct(*tracked) if tracked else F.struct(F.lit(1))

    # The snapshot calendar, one row per snapshot. Written once: by its file size Spark sees whether it
    # may be broadcast to the join below.
    order = Window.orderBy("_v")
    calendar = snapshots.select(F.col(version).alias("_v")).distinct()
    calendar = cut(
        calendar.select(
            "_v", F.lag("_v").over(order).alias("_before"), F.lead("_v").over(order).alias("_after")
        ),
        "snapshots",
    )
    by_key = Window.partitionBy(*keys).orderBy(version)
    starts = F.when(
        F.lag(version).over(by_key) == F.col(version), _refused("a snapshot holds a key twice")
    ).otherwise(
        F.lag(version).over(by_key).isNull()
        | (F.lag(version).over(by_key) != F.col("_before"))
        | ~F.lag(state).over(by_key).eqNullSafe(state)
    )
    runs = (
        snapshots.join(calendar, F.col(version) == F.col("_v"))
        .withColumn("_starts", starts)
        .withColumn(
            "_run",
            F.sum(F.col("_starts").cast("int")).over(by_key.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    return (
        runs.groupBy(*keys, "_run")
        .agg(
            F.min(version).alias(START),
            F.max_by(F.struct(*plain, F.col("_after")), version).alias("_last"),
        )
        .select(
            *keys,
            *[F.col(f"_last.`{c}`").alias(c) for c in plain],
            START,
            F.col("_last._after").alias(END),
        )
    )


def snapshot_step(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], version: object, track_except: Sequence[str] = ()
) -> DataFrame:
    """The history after one more full snapshot, equal to :func:`scd2_from_snapshots` over all of them.

    ``history`` holds everything up to the snapshot before; ``snapshot`` has its columns without the version. Open
    rows whose key is gone or whose tracked columns changed end at ``version``; unchanged ones stay open and take the
    untracked columns of the snapshot; new and changed keys open rows. A key twice in the snapshot fails.
    """
    keys = list(keys)
    twice = snapshot.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"a snapshot holds a key twice: {twice[0].asDict()}")
    plain = [c for c in history.columns if c not in (*keys, START, END)]
    tracked = [c for c in plain if c not in track_except]
    now = F.lit(version).cast(history.schema[START].dataType)
    fresh = snapshot.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*plain).alias("_new"))
    same_key = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    met = history.filter(F.col(END).isNull()).join(fresh, same_key, "left")
    state = lambda at: F.struct(*[F.col(f"{at}`{c}`") for c in tracked]) if tracked else F.struct(F.lit(1))
    stays = F.col("_new").isNotNull() & state("").eqNullSafe(state("_new."))
    met = met.withColumn("_stays", stays)
    carried = met.select(
        *keys,
        *[F.when(F.col("_stays"), F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in plain],
        START,
        F.when(~F.col("_stays"), now).alias(END),
    )
    held = met.filter("_stays").select(*[F.col(f"`{k}`").alias(f"_h{i}") for i, k in enumerate(keys)])
    known = reduce(Column.__and__, [F.col(f"_k{i}").eqNullSafe(F.col(f"_h{i}")) for i in range(len(keys))])
    opened = fresh.join(held, known, "left_anti").select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], "_new.*", now.alias(START), F.lit(None).cast(history.schema[END].dataType).alias(END)
    )
    columns = history.columns
    return history.filter(F.col(END).isNotNull()).select(*columns).union(carried.select(*columns)).union(opened.select(*columns))


def _open_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def _newest_start(history: DataFrame) -> Column:
    """The newest start over all versions, closed ones included."""
    return history.agg(F.max(START)).scalar()


def deleted(history: DataFrame) -> DataFrame:
    """Open versions that did not start at the newest start.

    This is the comparison of the original report. A key that did not change keeps its old start, so
    after change tracking unchanged keys are listed too; :func:`unseen` is the exact form.
    """
    return _open_rows(history).filter(F.col(START) != _newest_start(history))


def active(history: DataFrame) -> DataFrame:
    """Open versions that started at the newest start."""
    return _open_rows(history).filter(F.col(START) == _newest_start(history))


def final(live: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Active versions of keys without a deleted one."""
    return live.join(gone.select(*keys), list(keys), "left_anti")


def unseen(history: DataFrame, last_seen: str) -> DataFrame:
    """Open versions not seen in the newest load, by an untracked load column."""
    return _open_rows(history).filter(F.col(last_seen) < history.agg(F.max(last_seen)).scalar())
