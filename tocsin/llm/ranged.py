"""Running totals over a globally range-sorted table.

Rows are dealt to ranges of the order and written; only a row of totals for each range
meets in one task, and rows are summed inside their range. A key with a third of all
rows spreads over as many ranges as it needs, as long as the order tells its rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import stored

PART = "__part"
#: Rows of one range, about.
ROWS = 500_000


def ranges(rows: int, each: int = ROWS) -> int:
    return rows // each + 1


def dealt(df: DataFrame, order: list[Column], parts: int, label: str) -> DataFrame:
    """Written by ranges of ``order``, numbered upwards in the column ``__part``."""
    return stored(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), label)


def before(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For each range its own totals and, as ``before_*``, those of all lower ranges."""
    lower = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy(PART).agg(*[F.sum(value).alias(f"held_{name}") for name, value in sums.items()])
    return held.withColumns({f"before_{name}": F.coalesce(F.sum(f"held_{name}").over(lower), F.lit(0)) for name in sums})


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], parts: int, label: str) -> DataFrame:
    """Add the running total of each sum, the row's own value included."""
    rows = dealt(df, order, parts, label)
    # One row for each range, whatever the size of the table.
    lower = F.broadcast(before(rows, sums).select(PART, *[f"before_{name}" for name in sums]))
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.join(lower, PART).withColumns({name: F.sum(value).over(within) + F.col(f"before_{name}") for name, value in sums.items()})
    return found.drop(PART, *[f"before_{name}" for name in sums])


def first_beyond(df: DataFrame, order: list[Column], value: Column, limit: float, parts: int, label: str) -> dict | None:
    """The first row, in the given order, whose running total exceeds ``limit``.

    Whole ranges are passed over by their totals; rows are summed in one range only.
    """
    rows = dealt(df, order, parts, label)
    crossed = before(rows, {"v": value}).filter(F.col("before_v") + F.col("held_v") > limit)
    at = crossed.agg(F.min_by(F.struct(PART, "before_v"), PART).alias("at")).first()["at"]
    if at is None:
        return None
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.filter(F.col(PART) == at[PART]).withColumn("__total", F.sum(value).over(within) + at["before_v"])
    return own.filter(F.col("__total") > limit).orderBy(*order).drop(PART, "__total").first().asDict()
