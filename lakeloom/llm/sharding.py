"""Weighted rendezvous hashing of record keys, and gapless numbering inside shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.rows import running_offset

# Pieces of a shard that are numbered on their own.
PIECES = 1024
# Copies of one row are numbered in runs of this many.
RUN = 1 << 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: every shard draws a number from the key and its own index, and the highest wins.

    The draw is weight / -ln(u) with u between 0 and 1 from a 64-bit hash, so a shard wins in proportion to its
    weight. A draw depends on one shard alone: adding a shard moves only the keys it wins, to itself; changing a
    weight moves keys only from or to that shard. Ties go to the lower shard. A null key is a key like others.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, one per shard")

    def draw(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(float(weight)) / -F.log(u)).alias("draw"), F.lit(-shard).alias("low"))

    draws = [draw(i, w) for i, w in enumerate(weights)]
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    return (-best["low"]).cast("int")


def numbered(df: DataFrame, shard: str, order: Sequence[str], name: str = "slot", pieces: int = PIECES) -> DataFrame:
    """Every row of ``df`` with its place in its shard, from 0 without a gap.

    Equal rows are counted before anything is sorted, so a row repeated very often costs one row per task; the
    shard is numbered in ``pieces`` by a hash of ``order``, only piece totals meet, and copies are dealt out again
    in runs of bounded length.
    """
    same = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    cut = same.withColumn("_piece", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(pieces)))
    first = running_offset(cut, "_piece", list(order), F.col("_copies"), "_first", [shard])
    runs = first.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / RUN))))
    left = F.least(F.lit(RUN), F.col("_copies") - F.col("_run") * RUN)
    each = runs.withColumn("_at", F.explode(F.sequence(F.lit(0), (left - 1).cast("int"))))
    return each.withColumn(name, F.col("_first") + F.col("_run") * RUN + F.col("_at")).select(*[F.col(f"`{c}`") for c in df.columns], name)


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 8, more: float = 1.0) -> DataFrame:
    """Key, size and checksum of every row with its shard, its slot there, and ``grown_shard``, the shard once one
    more of weight ``more`` joins. Null texts have one byte of size and the checksum of nothing."""
    name, body = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        name,
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(name, weights).alias("shard"),
        rendezvous(name, [*weights, more]).alias("grown_shard"),
    )
    return numbered(rows, "shard", [key, "size", "text_crc32"])
