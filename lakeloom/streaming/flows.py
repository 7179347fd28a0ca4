"""File streams that run once over what is there: bronze, silver, quality, quarantine, upserts."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.rescue import RESCUED, rescued_columns, rescued_fields
from lakeloom.functions.times import COMPACT_STAMP, stamp_in
from lakeloom.operators.history import scd1, scd2, splice
from lakeloom.operators.quality import Rules, quarantine, watch
from lakeloom.session import delete_path, get_text, names_below, put_text


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder, each read once per checkpoint."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def json_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, rescued: str = RESCUED, files_per_batch: int | None = None
) -> DataFrame:
    """New files of JSON lines, with the declared columns and ``rescued``, the text of all fields that do not fit them."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return rescued_fields(reader.text(path), schema, "value", rescued)


def drifting_stream(spark: SparkSession, path: str, schema: T.StructType | str, rescued: str = RESCUED) -> DataFrame:
    """New Parquet files with the declared columns; other columns that any file has as text in ``rescued``.

    The columns of all files are looked up when the stream starts: a column that first comes while it runs is seen by the next run.
    """
    wide = spark.read.option("mergeSchema", True).parquet(path).schema
    return rescued_columns(file_stream(spark, path, wide), schema, rescued)


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append what is new to a Parquet folder and stop."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def run_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand what is new to ``each`` batch by batch and stop; a batch may be handed twice after a crash."""
    (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def bronze(
    stream: DataFrame, load_time: str, stamp: tuple[str, str] = COMPACT_STAMP
) -> DataFrame:
    """Raw rows with the file metadata, the time stamp in the file path, and the load time."""
    return stream.select(
        "*",
        "_metadata",
        stamp_in(F.col("_metadata.file_path"), *stamp).alias("filename_timestamp"),
        F.lit(load_time).cast("timestamp").alias("load_timestamp"),
    )


def with_folder(stream: DataFrame, name: str) -> DataFrame:
    """The name of the file's folder as a column, so one stream serves all sub-folders."""
    return stream.withColumn(name, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


COUNTS = "rule string, passed bigint, failed bigint"


def _keep_counts(spark: SparkSession, counts: Sequence[tuple[str, int, int]], path: str, number: int) -> None:
    """The observed counts of one batch as one small file under its number; no job of its own, and a batch that runs again replaces it."""
    names = [f.split()[0] for f in COUNTS.split(", ")]
    put_text(spark, f"{path}/batch={number}/counts.json", "\n".join(json.dumps(dict(zip(names, c))) for c in counts))


def rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per rule and ``batch``, as streams have kept them."""
    return spark.read.schema(COUNTS + ", batch bigint").json(path)


def run_expectations(
    stream: DataFrame, rules: Rules, action: str, path: str, metrics_path: str, checkpoint: str
) -> None:
    """Write the rows that pass and the counts per rule, one folder per batch.

    Rows and counts come from one read of the batch: the counts are observed while the rows are written. A batch that
    runs again after a crash replaces its own folder, so nothing is counted twice; :func:`rule_counts` reads them.
    """

    def each(batch: DataFrame, number: int) -> None:
        watched = watch(batch, rules, action)
        watched.rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        _keep_counts(batch.sparkSession, watched.counts(), metrics_path, number)

    run_batches(stream, each, checkpoint)


def run_quarantine(
    stream: DataFrame, rules: Rules, path: str, checkpoint: str, metrics_path: str | None = None
) -> None:
    """All rows with their flag, in one folder per flag value.

    With ``metrics_path`` the rules are counted beside the flag, one folder per batch there, from the same read.
    """
    if metrics_path is None:
        run_to_files(quarantine(stream, rules), path, checkpoint, ["is_quarantined"])
        return

    def each(batch: DataFrame, number: int) -> None:
        watched = watch(batch, rules, "warn")
        flagged = quarantine(watched.rows, rules)
        flagged.write.mode("overwrite").partitionBy("is_quarantined").parquet(f"{path}/batch={number}")
        _keep_counts(batch.sparkSession, watched.counts(), metrics_path, number)

    run_batches(stream, each, checkpoint)


# Pieces of the key space that an upserted table starts with, and rows per piece beyond which their number doubles.
BUCKETS, BUCKET_ROWS = 8, 1_000_000


class UpsertedTable:
    """Keyed state fed by streams, in buckets of the key's hash; a batch writes each bucket it touches anew, as one file.

    One small file names the state after a batch: the folder of each bucket, and per checkpoint the last batch that
    went in. So a batch that is handed again is skipped, and a stream with a new checkpoint goes on from the state it
    finds. A batch that dies leaves folders that no such file names; the next one replaces them. Folders whose
    buckets were written anew are removed. Batches of one table must not run at the same time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.path = path
        self.buckets = buckets
        self.bucket_rows = bucket_rows

    def _names(self) -> list[str]:
        return [n for n in names_below(self.spark, f"{self.path}/log") if n.endswith(".json")]

    def _latest(self) -> dict:
        names = self._names()
        if names:
            return json.loads(get_text(self.spark, f"{self.path}/log/{names[-1]}"))
        return {"number": -1, "of": self.buckets, "folders": {}, "full": False, "schema": "", "sizes": [], "done": {}}

    def _state(self, latest: dict, buckets: set[int] | None = None) -> DataFrame | None:
        """The rows of some buckets, by default of all."""
        paths = [f"{self.path}/state/{f}/bucket={b}" for b, f in latest["folders"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(latest["schema"]).parquet(*paths) if paths else None

    def _rows(self, latest: dict, buckets: set[int], kind: T.StructType) -> DataFrame:
        """What earlier batches brought for some buckets; fewer buckets than now are buckets put together."""
        found = self.spark.createDataFrame([], kind)
        for size in latest["sizes"]:
            part = self.spark.read.schema(T.StructType([*kind, *_PLACES])).parquet(f"{self.path}/rows/of={size}")
            here = F.col("bucket").isin(sorted({b % size for b in buckets})) & (F.col("generation") <= latest["number"])
            found = found.union(part.filter(here).select(*[F.col(f"`{f.name}`") for f in kind]))
        return found

    def read(self) -> DataFrame:
        """The state after the last batch."""
        state = self._state(self._latest())
        if state is None:
            raise ValueError(f"no finished batch below {self.path}")
        return state

    def _write(self, df: DataFrame, keys: Sequence[str], of: int, folder: str) -> int:
        """One file per bucket; the number of rows."""
        counted = Observation()
        placed = _bucketed(df, keys, of).repartition(of, "bucket").observe(counted, F.count(F.lit(1)).alias("rows"))
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return counted.get["rows"]

    def _each(self, batch: DataFrame, keys: Sequence[str], checkpoint: str, batch_number: int, build, keep_rows: bool) -> None:
        latest = self._latest()
        if latest["done"].get(checkpoint, -1) >= batch_number:
            return
        number, of, gone = latest["number"] + 1, latest["of"], []
        after = latest | {"number": number, "done": latest["done"] | {checkpoint: batch_number}}
        batch = batch.persist()
        try:
            touched = {r[0] for r in _bucketed(batch, keys, of).select("bucket").distinct().collect()}
            if touched:
                # A state whose buckets are full is dealt to twice as many, all at once.
                to, read = (2 * of, None) if latest["full"] else (of, touched)
                state = build(batch, self._state(latest, read), lambda: self._rows(latest, touched, batch.schema))
                if keep_rows:
                    self._write(batch, keys, of, f"rows/of={of}/generation={number}")
                folder = f"generation={number}"
                written = self._write(state, keys, to, f"state/{folder}")
                fresh = [n.partition("=")[2] for n in names_below(self.spark, f"{self.path}/state/{folder}") if n.startswith("bucket=")]
                kept = {b: f for b, f in latest["folders"].items() if read is not None and int(b) not in read}
                gone = [f"state/{f}/bucket={b}" for b, f in latest["folders"].items() if b not in kept]
                after |= {
                    "of": to, "folders": kept | dict.fromkeys(fresh, folder), "full": written > self.bucket_rows * len(fresh),
                    "schema": _ddl(state.schema), "sizes": sorted({*latest["sizes"], *([of] if keep_rows else [])}),
                }
        finally:
            batch.unpersist()
        names = self._names()
        put_text(self.spark, f"{self.path}/log/{number:012d}.json", json.dumps(after))
        for name in [*(f"log/{n}" for n in names), *gone]:
            delete_path(self.spark, f"{self.path}/{name}")

    def run_scd1(
        self, stream: DataFrame, keys: Sequence[str], sequence_by: str, checkpoint: str, ties: Sequence[str] = ()
    ) -> None:
        """Keep the row with the largest sequence per key; a late row never replaces a newer one."""

        def build(batch: DataFrame, old: DataFrame | None, seen: Callable[[], DataFrame]) -> DataFrame:
            return scd1(batch if old is None else old.unionByName(batch), keys, sequence_by, ties)

        run_batches(stream, lambda batch, n: self._each(batch, keys, checkpoint, n, build, False), checkpoint)

    def run_scd2(
        self,
        stream: DataFrame,
        keys: Sequence[str],
        sequence_by: str,
        checkpoint: str,
        track_except: Sequence[str] = (),
    ) -> None:
        """Keep the versions of each key, with ``LAST``, the sequence of a version's newest row.

        Rows that come after all others of their key meet its open version alone; late ones are spliced in between the
        versions around them, from the rows of that time, which are kept beside the state.
        """
        keys = list(keys)

        def build(batch: DataFrame, old: DataFrame | None, seen: Callable[[], DataFrame]) -> DataFrame:
            if old is None:
                return scd2(batch.distinct(), keys, sequence_by, track_except, with_last=True)
            return splice(old, batch, keys, sequence_by, track_except, seen)

        run_batches(stream, lambda batch, n: self._each(batch, keys, checkpoint, n, build, True), checkpoint)


_PLACES = (T.StructField("generation", T.IntegerType()), T.StructField("bucket", T.IntegerType()))


def _bucketed(df: DataFrame, keys: Sequence[str], of: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(of)).cast("int"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
