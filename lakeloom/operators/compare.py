"""Order-free comparison of tables: schema and multiset of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.filters import without_audit_columns
from lakeloom.operators.rows import copies, running_offset
from lakeloom.session import cut

# Relative and absolute tolerance for floating-point columns.
RTOL, ATOL = 1e-5, 1e-8


def schema_diff(source: DataFrame, target: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per column: equal, missing (in the target), extra, or of another type."""
    a = {f.name: f.dataType.simpleString() for f in without_audit_columns(source, exclude).schema}
    b = {f.name: f.dataType.simpleString() for f in without_audit_columns(target, exclude).schema}

    def status(name: str) -> str:
        if name not in b:
            return "missing"
        if name not in a:
            return "extra"
        return "equal" if a[name] == b[name] else "type"

    rows = [(n, a.get(n), b.get(n), status(n)) for n in dict.fromkeys([*a, *b])]
    return source.sparkSession.createDataFrame(
        rows, "column_name string, source_type string, target_type string, status string"
    )


def same_schema(source: DataFrame, target: DataFrame) -> bool:
    """Equal names, types and order."""
    return source.dtypes == target.dtypes


def signed_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of both sides with ``_n`` = times in the source minus times in the target, where not 0.

    One shuffle for both directions; equal rows cancel out inside every task first.
    """
    if not same_schema(source, target):
        raise ValueError(f"schemas differ: {source.dtypes} and {target.dtypes}")
    names = source.columns
    columns = [F.col(f"`{c}`") for c in names]
    both = source.select(*columns, F.lit(1).alias("_sign")).union(
        target.select(*columns, F.lit(-1).alias("_sign"))
    )
    return both.groupBy(*columns).agg(F.sum("_sign").alias("_n")).filter(F.col("_n") != 0)


def compare(source: DataFrame, target: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The rows one side has more often, with ``side`` and ``surplus``; empty when the sides are equal."""
    a, b = without_audit_columns(source, exclude), without_audit_columns(target, exclude)
    return (
        signed_counts(a, b)
        .withColumn("side", F.when(F.col("_n") > 0, "source").otherwise("target"))
        .withColumn("surplus", F.abs("_n"))
        .drop("_n")
    )


def _close(a: Column, b: Column, rtol: float, atol: float) -> Column:
    """Equal, both NULL, both NaN, or no farther apart than ``atol + rtol * |b|``."""
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.coalesce(a.eqNullSafe(b) | near, F.lit(False))


def compare_keyed(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    rtol: float = RTOL,
    atol: float = ATOL,
) -> DataFrame:
    """One row per key and copy that differs: ``missing``, ``extra`` or ``changed`` with the columns.

    Floating-point columns may differ within the tolerance. Exactly equal rows cancel out first, so
    the join sees the remaining rows only. Copies of a key are paired in the order of the other
    columns. Without ``keys`` all columns but the floating-point ones serve as keys.
    """
    a, b = without_audit_columns(source, exclude), without_audit_columns(target, exclude)
    floats = [f.name for f in a.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    keys = list(keys) if keys is not None else [c for c in a.columns if c not in floats]
    if not keys:
        raise ValueError("no key: all columns are floating-point")
    values = [c for c in a.columns if c not in keys]
    left_over = signed_counts(a, b)
    distinct_rows = left_over.withColumn("_source", F.col("_n") > 0).withColumn("_n", F.abs("_n"))
    # Rows of one key are numbered in pieces: ranges of keys and values with about equally many rows each, found by Spark
    # from a sample of the rows. A key that owns many rows lies in many pieces, whatever its values look like.
    first = next((c for c in values if c in floats), values[0] if values else None)
    order = ([first] if first else []) + [c for c in values if c != first] or keys
    ranged = distinct_rows.repartitionByRange(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *order])])
    pieces = cut(ranged.withColumn("_piece", F.spark_partition_id()), "pieces")
    placed = running_offset(pieces, "_piece", order, F.col("_n"), "_place", ["_source", *keys])
    # Copies of a row take the places from its offset on.
    numbered = copies(placed, "_n", "_copy").withColumn("_number", F.col("_place") + F.col("_copy") + 1)

    def side(is_source: bool, mark: str) -> DataFrame:
        return numbered.filter(F.col("_source") == is_source).select(
            *[F.col(k).alias(f"{mark}k{i}") for i, k in enumerate(keys)],
            F.col("_number").alias(f"{mark}n"),
            *[F.col(v).alias(f"{mark}v{i}") for i, v in enumerate(values)],
        )

    on = reduce(
        Column.__and__,
        [F.col("an") == F.col("bn")]
        + [F.col(f"ak{i}").eqNullSafe(F.col(f"bk{i}")) for i in range(len(keys))],
    )
    differing = [
        F.when(
            ~(
                _close(F.col(f"av{i}"), F.col(f"bv{i}"), rtol, atol)
                if v in floats
                else F.col(f"av{i}").eqNullSafe(F.col(f"bv{i}"))
            ),
            F.lit(v),
        )
        for i, v in enumerate(values)
    ]
    in_source, in_target = F.col("an").isNotNull(), F.col("bn").isNotNull()
    result = side(True, "a").join(side(False, "b"), on, "full_outer").select(
        *[
            F.when(in_source, F.col(f"ak{i}")).otherwise(F.col(f"bk{i}")).alias(k)
            for i, k in enumerate(keys)
        ],
        F.when(~in_target, "missing").when(~in_source, "extra").otherwise("changed").alias("status"),
        F.when(in_source & in_target, F.concat_ws(",", *differing)).alias("changed_columns"),
    )
    return result.filter((F.col("status") != "changed") | (F.col("changed_columns") != ""))


def verdict(source: DataFrame, target: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row: do schema and rows agree, and how many rows each side has more.

    Where the schemas differ the rows are not compared and the counts are NULL.
    """
    a, b = without_audit_columns(source, exclude), without_audit_columns(target, exclude)
    if not same_schema(a, b):
        return a.agg(
            F.lit(False).alias("schema_equal"),
            F.lit(None).cast("bigint").alias("source_only"),
            F.lit(None).cast("bigint").alias("target_only"),
            F.lit(False).alias("equal"),
        )
    surplus = F.col("surplus")
    return compare(a, b).agg(
        F.lit(True).alias("schema_equal"),
        F.coalesce(F.sum(F.when(F.col("side") == "source", surplus)), F.lit(0)).alias("source_only"),
        F.coalesce(F.sum(F.when(F.col("side") == "target", surplus)), F.lit(0)).alias("target_only"),
        (F.count(F.lit(1)) == 0).alias("equal"),
    )


def compare_all(
    schemas: Mapping[str, Mapping[str, DataFrame]],
    pairs: Sequence[tuple[str, str]],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """One verdict per pair of schemas and entity of the first schema.

    All frames of an entity with one row type are counted in a single aggregation, one count per schema; every pair
    is then a difference of two counts.
    """
    wanted: dict[str, list[tuple[str, str]]] = {}
    for pair in pairs:
        for entity in schemas[pair[0]]:
            wanted.setdefault(entity, []).append(pair)
    verdicts = []
    for entity, asked in wanted.items():
        frames = {n: without_audit_columns(schemas[n][entity], exclude) for pair in asked for n in pair}
        alike: dict[tuple, list[tuple[str, str]]] = {}
        for source, target in asked:
            if same_schema(frames[source], frames[target]):
                alike.setdefault(tuple(sorted(frames[source].dtypes)), []).append((source, target))
            else:
                verdicts.append(
                    verdict(frames[source], frames[target]).select(
                        F.lit(source).alias("source_schema"), F.lit(target).alias("target_schema"), F.lit(entity).alias("entity"), "*"
                    )
                )
        verdicts += [_verdicts(entity, frames, group) for group in alike.values()]
    return reduce(DataFrame.unionByName, verdicts)


def _verdicts(entity: str, frames: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    names = sorted({n for pair in pairs for n in pair})
    columns = [F.col(f"`{c}`") for c in frames[names[0]].columns]
    tagged = [frames[n].select(*columns, F.lit(i).alias("_side")) for i, n in enumerate(names)]
    counts = reduce(DataFrame.union, tagged).groupBy(*columns).agg(
        *[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(names))]
    )

    def more(a: str, b: str) -> Column:
        surplus = F.col(f"_n{names.index(a)}") - F.col(f"_n{names.index(b)}")
        return F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0))

    rows = counts.agg(
        F.array(
            *[
                F.struct(
                    F.lit(source).alias("source_schema"),
                    F.lit(target).alias("target_schema"),
                    F.lit(entity).alias("entity"),
                    F.lit(True).alias("schema_equal"),
                    more(source, target).alias("source_only"),
                    more(target, source).alias("target_only"),
                    ((more(source, target) == 0) & (more(target, source) == 0)).alias("equal"),
                )
                for source, target in pairs
            ]
        ).alias("_all")
    )
    return rows.select(F.explode("_all").alias("_one")).select("_one.*")


def require_equal(source: DataFrame, target: DataFrame, exclude: Sequence[str] = ()) -> None:
    """Raise with a count and a few examples when the frames differ."""
    a, b = without_audit_columns(source, exclude), without_audit_columns(target, exclude)
    if not same_schema(a, b):
        raise AssertionError(f"schemas differ: {a.dtypes} and {b.dtypes}")
    result = compare(a, b)
    examples = result.limit(5).collect()
    if examples:
        raise AssertionError(f"rows differ, for example {examples}")
