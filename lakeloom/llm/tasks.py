"""Running a function over Arrow batches inside tasks."""

from __future__ import annotations

import importlib
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions of this package travel to the executors with the job; nothing has to be installed there.
cloudpickle.register_pickle_by_value(importlib.import_module("lakeloom.llm"))


def map_batches(df: DataFrame, work: Callable, schema: T.StructType | str, rows: int = 2000) -> DataFrame:
    """``mapInArrow``; ``work`` goes from an iterator of record batches of at most ``rows`` rows to an iterator of record batches.

    Spark ends a batch at 64 MB (``spark.sql.execution.arrow.maxBytesPerBatch``), so very long texts do not add up; the
    settings of the session stay as they are.
    """

    def sliced(batches: Batches) -> Batches:
        return work(batch.slice(i, rows) for batch in batches for i in range(0, batch.num_rows, rows))

    return df.mapInArrow(sliced, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, exactly as spelled; other columns cannot clash with what is added."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column of the frame has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


Batches = Iterator[pa.RecordBatch]


def worker_store(owner: str, name: str, *kinds: str) -> list[dict]:
    """Dictionaries that live as long as the Python worker, so that tasks after the first find them filled, one per kind.

    For values that follow from ``name`` and their key alone (a word and its ids): it changes the time, never a result. A worker
    holds those of one owner and name; others start anew and let them go.
    """
    module = sys.modules.setdefault("_lakeloom_worker", types.ModuleType("_lakeloom_worker"))
    if vars(module).get("holder") != (owner, name):
        module.holder, module.stores = (owner, name), {}
    return [module.stores.setdefault(kind, {}) for kind in kinds]


def scored_by_text(work: Callable[[list[str]], list[float]], rows: int = 500) -> Callable:
    """An Arrow function from a text column to doubles; ``work`` gets the texts, nulls as empty ones, in parts of ``rows``."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out: list[float] = []
        for i in range(0, len(texts), rows):
            out += work([t or "" for t in texts.slice(i, rows).to_pylist()])
        return pa.array(out, pa.float64())

    return scored
