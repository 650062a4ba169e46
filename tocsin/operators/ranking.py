"""Global ranks and dense numbering without a window over one unpartitioned task.

Both split the values into a fixed number of buckets, count each bucket, turn
the counts into a start offset per bucket and number within the bucket. Only
the bucket counts, at most ``buckets`` rows, ever meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_offset(df: DataFrame, bucket: str, weight: Column) -> DataFrame:
    """Add ``_before``, the total weight in all lower buckets."""
    totals = df.groupBy(bucket).agg(F.sum(weight).alias("_weight"))
    lower = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(bucket, F.coalesce(F.sum("_weight").over(lower), F.lit(0)).alias("_before"))
    # Bounded by the number of buckets, whatever the size of df. A left join, as an
    # inner one would push a null test into this branch and so compute df twice.
    return df.join(F.broadcast(offsets), bucket, "left")


def rank_by(df: DataFrame, value: str, name: str, buckets: int = 256) -> DataFrame:
    """``RANK() OVER (ORDER BY value)``, nulls first.

    Equal values are folded into one row with a count before anything is
    ordered, so a value shared by many rows costs no more than any other.
    """
    values = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = values.agg(F.percentile_approx(value, steps, 8 * buckets)).scalar()
    lower_cuts = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    bucket = F.when(F.col(value).isNull(), -1).otherwise(lower_cuts)
    bucketed = values.withColumn("_cuts", cuts).withColumn("_bucket", bucket).drop("_cuts")
    spread = _with_offset(bucketed, "_bucket", F.col("_n"))
    earlier = (
        Window.partitionBy("_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    position = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1
    ranks = spread.select(F.col(value).alias("_value"), position.cast("bigint").alias(name))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def number_keys(keys: DataFrame, name: str, buckets: int = 1024) -> DataFrame:
    """Give each distinct row an id from 1 up, without gaps.

    The ids depend only on the set of rows, so a recomputed task gives the same
    ones, and unlike hashes they cannot collide.
    """
    columns = keys.columns
    bucketed = keys.distinct().withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    spread = _with_offset(bucketed, "_bucket", F.lit(1))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*columns))
    return spread.select((F.col("_before") + within).cast("bigint").alias(name), *columns)
