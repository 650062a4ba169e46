"""Row cleaning. Statistics over a whole table come from a scalar subquery: one
distributed aggregate whose single row Spark hands to every task. Rows are
never gathered and no join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.functions import scalar


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as null, so that no statistic is spoilt by it."""
    value = F.col(f"`{column}`")
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return F.when(~F.isnan(value), value) if floating else value


def impute_mean(df: DataFrame, column: str = "response_time") -> DataFrame:
    """Replace nulls and NaN by the mean of the other values."""
    value = known(df, column)
    mean = df.agg(F.avg(value)).scalar()
    return df.withColumn(column, F.coalesce(value, mean))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_null_key(df: DataFrame, key: str = "incident_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def scaled(value: Column, low: Column, high: Column) -> Column:
    return F.try_divide(value - low, high - low)


def minmax_scale(df: DataFrame, column: str = "response_time") -> DataFrame:
    """Add ``<column>_normalized`` in 0..1; null where all values are equal."""
    value = known(df, column)
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    return df.withColumn(
        f"{column}_normalized", scaled(value, bounds.getField("low"), bounds.getField("high"))
    )


def validate_in(
    df: DataFrame,
    column: str = "severity",
    allowed: list[str] = scalar.VALID_SEVERITIES,
    flag: str = "valid_severity",
) -> DataFrame:
    return df.withColumn(flag, scalar.is_in(column, allowed))


def moments(df: DataFrame, column: str) -> Column:
    """Mean and sample deviation as one struct value."""
    value = known(df, column)
    return df.agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    ).scalar()


def z_score(df: DataFrame, column: str = "response_time") -> Column:
    """Distance from the mean in deviations; null when the deviation is null or 0."""
    stats = moments(df, column)
    return F.try_divide(known(df, column) - stats.getField("mean"), stats.getField("std"))


def zscore_outliers(df: DataFrame, column: str = "response_time", limit: float = 3.0) -> DataFrame:
    return df.filter(F.abs(z_score(df, column)) > limit)


def normalize_column(df: DataFrame, column: str = "severity") -> DataFrame:
    return df.withColumn(column, scalar.normalize_text(column))


def lower_column(df: DataFrame, column: str = "severity") -> DataFrame:
    return df.withColumn(column, F.lower(column))


def coerce_numeric(df: DataFrame, column: str = "response_time") -> DataFrame:
    return df.withColumn(column, scalar.coerce_number(column))


def below(df: DataFrame, column: str = "response_time", limit: float = scalar.VALID_LIMIT_SECONDS) -> DataFrame:
    """Rows under the limit; null values do not qualify."""
    return df.filter(F.col(column) < limit)


def narrow_types(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast to smaller types. A value that does not fit becomes null rather than
    wrapping around, so count the nulls where that can happen."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in columns.items()})
