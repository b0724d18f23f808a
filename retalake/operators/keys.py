"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retalake.session import Scratch

# Fixed value: bits of monotonically_increasing_id that count rows inside a partition.
_ROW_BITS = 33


def dense_id(
    df: DataFrame, name: str, scratch: Scratch, order: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... over all rows, following ``order`` where given.

    Rows are sorted by range partitions and written once with their position,
    which fixes both. A key is then the number of rows in earlier partitions
    plus the position. Those counts are one row per partition, so adding them
    up in one task and broadcasting them is cheap at any table size.
    """
    columns = df.columns
    if order:
        keys = [F.col(c).asc_nulls_first() for c in order]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = scratch.save(
        df.select(F.monotonically_increasing_id().alias("_place"), *columns), name
    )
    partition = F.shiftright("_place", _ROW_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_partition")) - F.col("_rows")
    starts = sizes.select("_partition", before.alias("_start"))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(starts), "_partition")
        .select((F.col("_start") + position).alias(name), *columns)
    )


def hash_id(columns: tuple[str, ...]) -> Column:
    """64-bit id from the values alone, the same wherever it is computed. A NULL differs from every value."""
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts)


class HashCollision(Exception):
    """Two natural keys of a dimension have one hash id."""


def hashed_keys(keys: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """The written distinct ``keys`` with their hash id in front; fails if two of them share one."""
    rows = scratch.save(keys.select(hash_id(tuple(keys.columns)).alias(name), *keys.columns), f"{name}-hashed")
    twice = rows.groupBy(name).agg(F.count("*").alias("_n")).where("_n > 1").limit(1).collect()
    if twice:
        raise HashCollision(f"{name} {twice[0][0]} stands for {twice[0]._n} keys")
    return rows
