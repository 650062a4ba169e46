"""Physical layout of a frame."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_by_key(df: DataFrame, *keys: str, strict: bool = False) -> DataFrame:
    """Bring rows of a key together.

    By default through a rebalance, which splits a key too large for one
    partition and joins small ones. ``strict`` keeps every key in one partition
    whatever its size; use it only where that is required.
    """
    if strict:
        return df.repartition(*keys)
    return df.hint("rebalance", *[F.col(k) for k in keys])


def partition_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per partition and key. Counting happens inside each partition."""
    placed = df.select(F.spark_partition_id().alias("partition_id"), *keys)
    return placed.groupBy("partition_id", *keys).agg(F.count(F.lit(1)).alias("rows"))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that is read more than once, and free it afterwards. What does
    not fit in memory goes to disk; a lost block is computed again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
