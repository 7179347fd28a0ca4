"""Copy-on-write versions of a table in a folder, and the change feed between them.

A version is a folder ``version=N`` of Parquet files. A row in the version log makes it visible, so
a run that dies while writing leaves nothing a reader would see.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.compare import signed_counts
from lakeloom.operators.rows import as_number, copies, rank_among, running_offset, with_columns_of
from lakeloom.session import cut
from lakeloom.sources.files import file_listing

LOG_SCHEMA = "version int, committed_at timestamp, operation string, row_count bigint"
CHANGE, COMMIT, COMMIT_TIME = "_change_type", "_commit_version", "_commit_timestamp"


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; all expressions see the old row."""
    return df.select(
        *[
            F.when(condition, changes[f.name]).otherwise(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
            if f.name in changes
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where the condition is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def insert(df: DataFrame, rows: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Append rows by name; columns they lack take the default, or NULL without one."""
    for name, value in (defaults or {}).items():
        given = F.col(name) if name in rows.columns else F.lit(None)
        rows = rows.withColumn(name, F.coalesce(given, F.lit(value)))
    return df.union(with_columns_of(rows, df.schema))


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """A new column, NULL in old rows; nothing changes when it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def _unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key occurs twice; a NULL key never matches, so it may repeat."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    twice = df.filter(known).groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{what} holds a key more than once: {twice[0].asDict()}")


def _known(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update all columns of matched rows, insert the others; source keys must be unique.

    Rows with a NULL in their key never match and take no part in a join. Target rows look up their one source
    row in a left join, whose frequent keys can be split; source rows without a target are found against the
    distinct target keys.
    """
    keys = list(keys)
    _unique(source, keys, "the merge source")
    known = _known(keys)
    rows = with_columns_of(source, target.schema)
    new = rows.filter(known).select(F.struct(*target.columns).alias("_new"), *[F.col(f"`{k}`").alias(f"_s{i}") for i, k in enumerate(keys)])
    on = reduce(Column.__and__, [F.col(f"`{k}`") == F.col(f"_s{i}") for i, k in enumerate(keys)])
    old = F.struct(*target.columns)
    kept = target.filter(known).join(new, on, "left").select(F.coalesce("_new", old).alias("_row")).select("_row.*")
    held = target.filter(known).select(*[F.col(f"`{k}`").alias(f"_s{i}") for i, k in enumerate(keys)]).distinct()
    added = rows.filter(known).join(held, on, "left_anti")
    return kept.union(added).union(target.filter(~known)).union(rows.filter(~known))


def change_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes between two states: insert, delete, update_preimage, update_postimage.

    Equal rows of both states cancel first, however often they occur; what is left of a key must be one row per
    state at most, else the job fails. Rows with a NULL in their key have no identity: they are inserted or
    deleted, never updated.
    """
    left = signed_counts(with_columns_of(after, before.schema), before).withColumn("_times", F.abs("_n"))
    return _paired(left, before.columns, list(keys), [])


def _paired(left: DataFrame, names: Sequence[str], keys: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Rows that came (``_n`` above 0) and went, ``_times`` each, as changes per key and ``within``."""
    columns = [F.col(f"`{c}`") for c in names]

    def note(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    known = _known(keys)
    kind = F.when(F.col("_n") > 0, "insert").otherwise("delete")
    free = copies(left.filter(~known).withColumn(CHANGE, kind), "_times", "_copy").select(*columns, CHANGE, *within)
    row = F.struct(*columns)
    paired = left.filter(known).groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *within).agg(
        F.first(F.when(F.col("_n") < 0, row), ignorenulls=True).alias("_old"),
        F.first(F.when(F.col("_n") > 0, row), ignorenulls=True).alias("_new"),
        F.sum(F.when(F.col("_n") < 0, F.col("_times"))).alias("_olds"),
        F.sum(F.when(F.col("_n") > 0, F.col("_times"))).alias("_news"),
    )
    twice = (F.coalesce("_olds", F.lit(0)) > 1) | (F.coalesce("_news", F.lit(0)) > 1)
    refused = F.raise_error(F.lit("a state holds a key more than once, with different rows"))
    notes = (
        F.when(twice, F.array(F.struct(refused.cast("string").alias("kind"), F.col("_new").alias("row"))))
        .when(F.col("_old").isNull(), F.array(note("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(note("delete", "_old")))
        .otherwise(F.array(note("update_preimage", "_old"), note("update_postimage", "_new")))
    )
    noted = paired.select(F.explode(notes).alias("_n"), *within).select("_n.row.*", F.col("_n.kind").alias(CHANGE), *within)
    return noted.union(free)


# States that one aggregation counts side by side.
RUN = 32


def states_of_rows(states: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows with ``_times``, how often each state holds them, in the order of the states.

    Every state is read once and all meet in one aggregation, which works inside every task first. Columns that a state lacks are NULL.
    """
    wide = reduce(lambda a, b: a.unionByName(b.limit(0), allowMissingColumns=True), states).schema
    tagged = [with_columns_of(df, wide).withColumn("_state", F.lit(i)) for i, df in enumerate(states)]
    every = reduce(DataFrame.union, tagged)
    times = [F.count_if(F.col("_state") == i) for i in range(len(states))]
    return every.groupBy(*[F.col(f"`{f.name}`") for f in wide]).agg(F.array(*times).alias("_times"))


def change_feed(states: Mapping[int, DataFrame], keys: Sequence[str], times: Mapping[int, str] | None = None) -> DataFrame:
    """Changes from each state to the next: columns, kind, ``_commit_version`` and, with ``times``, ``_commit_timestamp``.

    ``states`` are numbered; changes carry the number of the later state. A row whose count differs between neighbours has
    come or gone there; only such rows go on to be paired by key and state. Rules are those of :func:`change_rows`: copies
    of a row cancel, what is left of a key is one row per state at most, and rows with a NULL in their key are inserted or deleted.
    """
    numbers, keys = sorted(states), list(keys)
    feeds = [_feed({n: states[n] for n in numbers[at : at + RUN + 1]}, keys) for at in range(0, max(1, len(numbers) - 1), RUN)]
    feed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    if times is None:
        return feed
    stamp = F.element_at(F.create_map(*[x for n in numbers for x in (F.lit(n), F.lit(times[n]).cast("timestamp"))]), F.col(COMMIT))
    return feed.withColumn(COMMIT_TIME, stamp)


def _feed(states: Mapping[int, DataFrame], keys: list[str]) -> DataFrame:
    numbers = list(states)
    rows = states_of_rows([states[n] for n in numbers])
    columns = [F.col(f"`{c}`") for c in rows.columns if c != "_times"]
    at = lambda i: F.col("_times")[i]
    flips = F.array(*[F.struct(F.lit(numbers[i]).alias("n"), (at(i) - at(i - 1)).alias("d")) for i in range(1, len(numbers))])
    moved = rows.withColumn("_flip", F.explode(F.filter(flips, lambda f: f["d"] != 0)) if len(numbers) > 1 else F.explode(F.array().cast("array<struct<n:int,d:bigint>>")))
    moved = moved.select(*columns, F.col("_flip.n").alias(COMMIT), F.col("_flip.d").alias("_n"), F.abs("_flip.d").alias("_times"))
    return _paired(moved, [c for c in moved.columns if c not in (COMMIT, "_n", "_times")], keys, [COMMIT])


def apply_changes(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a change feed: touched keys leave, inserted rows and postimages come."""
    touched = changes.select(*keys).distinct()
    fresh = changes.filter(F.col(CHANGE).isin("insert", "update_postimage")).select(*df.columns)
    return df.join(touched, list(keys), "left_anti").select(*df.columns).union(fresh)


def spread_bits(value: Column, bits: int) -> Column:
    """A number with a zero bit after each of its low ``bits`` bits."""
    pieces = [
        F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)), 2 * bit) for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), pieces)


def _text_ranks(df: DataFrame, name: str, ranks: int) -> DataFrame:
    """(_value, _rank) of every distinct text: its place among all rows in text order, as one of ``ranks`` shares.

    Values are counted first; ranges of values then give their totals, so no task holds them all.
    """
    counted = df.filter(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    ranges = cut(counted.repartitionByRange("_value").withColumn("_range", F.spark_partition_id()), "values")
    total = ranges.agg(F.sum("_rows")).scalar()
    placed = running_offset(ranges, "_range", ["_value"], F.col("_rows"), "_before")
    return placed.select("_value", F.floor(F.col("_before") * ranks / total).cast("int").alias("_rank"))


def clustered(df: DataFrame, first: str, second: str, partitions: int, bits: int = 6) -> DataFrame:
    """Rows laid out by two columns at once, so that file statistics narrow filters on either.

    Both columns become ranks among ``2**bits`` shares of the rows: numbers and times by approximate quantiles,
    texts by their place among all values, whole values compared. The ranks' bits are interleaved and the rows
    range-partitioned by the result, then by a digest, which splits a frequent pair. NULL ranks first.
    """
    # 63 numbers per column reach the driver, whatever the size of the table; one aggregation gives those of both.
    cuts, accuracy = [i / 2**bits for i in range(1, 2**bits)], 2 ** (bits + 4)
    texts = [c for c in (first, second) if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = {mark: as_number(df, c) for mark, c in (("_x", first), ("_y", second)) if c not in texts}
    bounds = df.agg(*[F.percentile_approx(n, cuts, accuracy).alias(mark) for mark, n in numbers.items()]).first() if numbers else {}
    placed = df
    for mark, name in (("_x", first), ("_y", second)):
        if name in texts:
            ranks = _text_ranks(df, name, 2**bits).withColumnsRenamed({"_value": f"_value{mark}", "_rank": mark})
            placed = placed.join(ranks, F.col(f"`{name}`") == F.col(f"_value{mark}"), "left").drop(f"_value{mark}")
            placed = placed.withColumn(mark, F.coalesce(mark, F.lit(0)))
        else:
            placed = placed.withColumn(mark, numbers[mark]).withColumn(mark, rank_among(mark, bounds[mark], repeated=True))
    curve = spread_bits(F.col("_x"), bits).bitwiseOR(F.shiftleft(spread_bits(F.col("_y"), bits), 1))
    # One number is the sort key: the place on the curve, and below it a digest that splits a frequent pair.
    key = F.shiftleft(curve.cast("bigint"), 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64(*df.columns), 24))
    return placed.withColumn("_z", key).repartitionByRange(partitions, "_z").sortWithinPartitions("_z").drop("_x", "_y", "_z")


def touched_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column the share of the files that a filter on one of its values has to read, on average over the range.

    Found from the smallest and largest value in each file, as Spark's readers see them. 1 means that the layout does not help.
    """
    file = F.col("_metadata.file_path").alias("_file")
    numbers = df.select(file, *[as_number(df, c).alias(c) for c in columns])
    ranges = numbers.groupBy("_file").agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    share = lambda c: F.avg(F.col(f"{c}.hi") - F.col(f"{c}.lo")) / (F.max(f"{c}.hi") - F.min(f"{c}.lo"))
    return ranges.agg(*[F.coalesce(share(c), F.lit(1.0)).alias(c) for c in columns])


class VersionedTable:
    """A table kept as numbered Parquet versions below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def log(self) -> DataFrame:
        """Version, commit time, operation and row count; one small row per version."""
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def latest(self) -> int:
        found = self.log().agg(F.max("version")).first()[0]
        if found is None:
            raise ValueError(f"no version below {self.path}")
        return found

    def commit(self, df: DataFrame, operation: str, at: str, version: int | None = None) -> int:
        """Write a new version and log it; the count is observed while the rows are written.

        A folder left by a run that died before its log row is replaced. The log row is the commit;
        writers of one table must not run at the same time.
        """
        number = version if version is not None else self.latest() + 1
        seen = Observation(f"commit-{number}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self._folder(number))
        entry = self.spark.createDataFrame(
            [(number, operation, seen.get.get("rows", 0))], "version int, operation string, row_count bigint"
        ).withColumn("committed_at", F.lit(at).cast("timestamp"))
        entry.select("version", "committed_at", "operation", "row_count").coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/log")
        return number

    def create(self, df: DataFrame, at: str, operation: str = "CREATE") -> int:
        return self.commit(df, operation, at, 0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._folder(self.latest() if version is None else version))

    def version_at(self, moment: str) -> int:
        """The last version committed at or before a moment."""
        found = (
            self.log().filter(F.col("committed_at") <= F.lit(moment).cast("timestamp")).agg(F.max("version")).first()[0]
        )
        if found is None:
            raise ValueError(f"no version at {moment}")
        return found

    def read_at(self, moment: str) -> DataFrame:
        return self.read(self.version_at(moment))

    def added(self, old: int, new: int, distinct: bool = False) -> DataFrame:
        """Rows of ``new`` that ``old`` lacks, with or without copies."""
        a, b = self.read(new), self.read(old)
        return a.subtract(b) if distinct else a.exceptAll(b)

    def restore(self, version: int, at: str) -> int:
        """A new version equal to an old one."""
        return self.commit(self.read(version), f"RESTORE {version}", at)

    def changes(self, keys: Sequence[str], first: int, last: int | None = None) -> DataFrame:
        """The change feed of versions ``first`` to ``last``, both included.

        Version 0 has no version before it: all its rows are inserts. Without ``last`` the feed ends with the
        latest version; a range that is empty or reaches beyond it is an error.
        """
        latest = self.latest()
        last = latest if last is None else last
        if not 0 <= first <= last <= latest:
            raise ValueError(f"no versions {first} to {last}: the latest is {latest}")
        states = {v: self.read(v) for v in range(max(first - 1, 0), last + 1)}
        if first == 0:
            states[-1] = states[0].limit(0)
        feed = change_feed(states, keys)
        times = self.log().select(F.col("version").alias(COMMIT), F.col("committed_at").alias(COMMIT_TIME))
        return feed.join(times, COMMIT)

    def compact(self, target_bytes: int, at: str) -> dict[str, int]:
        """Rewrite the latest version in files of about ``target_bytes``; file counts before and after."""
        current = self.read()
        before = self.files(self.latest())
        size = before.agg(F.sum("size")).first()[0] or 0
        count = max(1, -(-size // target_bytes))
        version = self.commit(current.repartition(int(count)), "COMPACT", at)
        return {"before": before.count(), "after": self.files(version).count()}

    def files(self, version: int) -> DataFrame:
        return file_listing(self.spark, self._folder(version), "*.parquet")
