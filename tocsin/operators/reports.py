"""Grouped reports. Each is one partial and one final hash aggregate, so a group
that holds most of the rows is folded before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.functions import scalar
from tocsin.operators.clean import below
from tocsin.operators.ranking import rank_by


def zone_analysis(
    df: DataFrame,
    zone: str = "zone",
    value: str = "response_time",
    key: str = "incident_id",
    unit: str = "s",
    limit: float = scalar.VALID_LIMIT_SECONDS,
) -> DataFrame:
    """Count, mean and maximum response in minutes per zone, fastest zone first."""
    return (
        below(df, value, limit)
        .withColumn("response_mins", scalar.minutes(value, unit))
        .groupBy(zone)
        .agg(
            F.count(key).alias("total_incidents"),
            F.avg("response_mins").alias("avg_response_mins"),
            F.max("response_mins").alias("max_response_mins"),
        )
        .orderBy("avg_response_mins", zone)
    )


def zone_sql(df: DataFrame) -> DataFrame:
    """The same report as SQL text over a temporary view."""
    return df.sparkSession.sql(
        """
        SELECT zone, count(*) AS total, round(avg(response_time / 60), 2) AS avg_mins
        FROM {incidents}
        WHERE response_time < {limit}
        GROUP BY zone
        ORDER BY avg_mins, zone
        """,
        incidents=df,
        limit=scalar.VALID_LIMIT_SECONDS,
    )


def critical_by_zone(df: DataFrame) -> DataFrame:
    """Critical incidents per zone in any letter case, fastest zone first."""
    return (
        df.filter(scalar.is_critical("severity", ignore_case=True))
        .groupBy("zone")
        .agg(F.count(F.lit(1)).alias("total"), F.avg("response_time").alias("avg_time"))
        .orderBy("avg_time", "zone")
    )


def aggregate_by_zone(df: DataFrame) -> DataFrame:
    """Count and mean per zone; rows without a zone are left out."""
    return (
        df.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(
            F.count("incident_id").alias("total_incidents"),
            F.avg("response_time").alias("avg_response_time"),
        )
    )


def rank_zones(df: DataFrame, zone: str = "zone", value: str = "response_time") -> DataFrame:
    """Zones ranked by mean response, the fastest first."""
    means = df.groupBy(zone).agg(F.avg(value).alias("avg_time"))
    return rank_by(means, "avg_time", "speed_rank").select(zone, "avg_time", "speed_rank")


def dashboard(df: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Per zone: incidents, mean response and critical count, busiest zone first.

    The critical count compares the stored text as it is; pass ``ignore_case``
    for sources that capitalise severities.
    """
    return (
        df.groupBy("zone")
        .agg(
            F.count(F.lit(1)).alias("incidents"),
            F.avg("response_time").alias("avg_response"),
            F.count_if(scalar.is_critical("severity", ignore_case)).alias("critical_count"),
        )
        .orderBy(F.desc("incidents"), "zone")
    )


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def critical_only(df: DataFrame) -> DataFrame:
    return df.filter(scalar.is_critical("severity"))


def global_average(df: DataFrame, value: str = "response_time") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.avg(value).alias("avg_value"))


def side_by_side(**tables: DataFrame) -> DataFrame:
    """Row count and mean response of several tables, one row per table."""
    rows = None
    for name, df in tables.items():
        row = df.agg(
            F.count(F.lit(1)).alias("total_rows"), F.avg("response_time").alias("avg_response")
        ).select(F.lit(name).alias("table_name"), "total_rows", "avg_response")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def anomalies(df: DataFrame, event_time: str = "event_time") -> DataFrame:
    """Critical or slow alerts with the reason. Works on batch and stream frames."""
    return df.filter(scalar.is_anomaly("severity", "response_time")).select(
        "incident_id",
        "incident_type",
        "zone",
        "severity",
        F.round(scalar.minutes("response_time"), 1).alias("response_mins"),
        "unit_id",
        "hospital_id",
        event_time,
        scalar.anomaly_reason("severity", "response_time").alias("anomaly_reason"),
    )


def dispatches(df: DataFrame) -> DataFrame:
    """Dispatch order for every critical alert."""
    return critical_only(df).select(
        "incident_id", scalar.dispatch_text("unit_id", "zone", "hospital_id").alias("message")
    )


def alert_stats(df: DataFrame) -> DataFrame:
    """Alerts per severity, zone and type in one pass; a missing value is ``unknown``."""
    dimensions = ["severity", "zone", "incident_type"]
    pairs = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d), F.lit("unknown")).alias("value"))
            for d in dimensions
        ]
    )
    return (
        df.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("alerts"))
    )


def alert_cube(df: DataFrame, dimensions: tuple[str, ...] = ("severity", "zone", "incident_type")) -> DataFrame:
    """Alerts by each dimension and in all, in one aggregate over grouping sets. A missing
    value is ``unknown``; the row of all alerts has dimension and value ``all``."""
    known = df.select(*[F.coalesce(F.col(d), F.lit("unknown")).alias(d) for d in dimensions])
    sets = [[F.col(d)] for d in dimensions]
    grouped = known.groupingSets([*sets, []], *dimensions).agg(F.count(F.lit(1)).alias("alerts"), *[F.grouping(d).alias(f"_{d}") for d in dimensions])
    dimension, value = F.lit("all"), F.lit("all")
    for d in dimensions:
        dimension = F.when(F.col(f"_{d}") == 0, F.lit(d)).otherwise(dimension)
        value = F.when(F.col(f"_{d}") == 0, F.col(d)).otherwise(value)
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "alerts")


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in order; Spark keeps only ``n`` per task while it sorts."""
    return df.orderBy(*order).limit(n)
