"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on: UTC clock, AQE with skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Wide plans are built much faster without a stack trace per column.
        "spark.sql.dataFrameQueryContext.enabled": "false",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Paths given out, by application.
_NAMED: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and the master is local.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _NAMED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in any store that Spark reaches; nothing happens where there is none."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a folder lies at the path, in any store that Spark reaches."""
    system, place = _file_system(spark, path)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it does not exist."""
    system, place = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file; it appears under its name when it is complete."""
    system, place = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(place, False)
    system.rename(draft, place)


def get_text(spark: SparkSession, path: str) -> str:
    """What :func:`put_text` wrote."""
    system, place = _file_system(spark, path)
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def clear_scratch(spark: SparkSession) -> int:
    """Delete what lies at the paths that :func:`scratch` gave out in this application; returns their number.

    For the end of a job: frames that read there, results of loops among them, cannot be used any more.
    """
    paths = _NAMED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write the frame once and read it back.

    The plan of the result is a plain scan with known file sizes, so loops keep short plans, a lost
    executor re-reads files instead of re-running rounds, and Spark's own size limit decides broadcasts.
    """
    return cut_and_count(df, name)[0]


def cut_and_count(
    df: DataFrame, name: str = "cut", where: Column | None = None
) -> tuple[DataFrame, int]:
    """:func:`cut`, with the number of rows (``where`` a condition holds) observed on the way."""
    path = scratch(df.sparkSession, name)
    seen = Observation()
    counted = F.count(F.lit(1)) if where is None else F.count_if(where)
    df.observe(seen, counted.alias("rows")).write.parquet(path)
    rows = seen.get.get("rows", 0)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows
