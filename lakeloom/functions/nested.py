"""Flattening of structs and arrays."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Leaf = tuple[str, Column, T.DataType]


def leaves(name: str, value: Column, kind: T.DataType) -> Iterator[Leaf]:
    """The members of a struct, down to the first level that is no struct, named by their path."""
    if isinstance(kind, T.StructType):
        for member in kind:
            yield from leaves(f"{name}_{member.name}", value.getField(member.name), member.dataType)
    else:
        yield name, value, kind


def flatten(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Structs as ``a_b`` columns and arrays as rows, until nothing nested is left: one projection per array.

    A row whose array is empty or NULL disappears unless ``keep_empty``; maps stay as they are. The
    name of the first nested column, with its ``_``, is cut from all column names.
    """
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    if not nested:
        return df
    rows_of = F.explode_outer if keep_empty else F.explode
    while True:
        found = [leaf for f in df.schema for leaf in leaves(f.name, F.col(f"`{f.name}`"), f.dataType)]
        array = next((name for name, _, kind in found if isinstance(kind, T.ArrayType)), None)
        df = df.select(*[(rows_of(value) if name == array else value).alias(name) for name, value, _ in found])
        if array is None:
            return df.toDF(*[c.replace(f"{nested[0]}_", "") for c in df.columns])
