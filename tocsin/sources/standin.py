"""The given tables read as incidents, for queries, tests and the benchmark.

``events`` holds no incidents, so zones, severities and so on are derived from
its columns: with nulls, negative and huge durations and severities in mixed
case. ``alert_key`` repeats, as when an incident is reported again and again.
The SQL twin of this mapping is ``INCIDENTS_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin import schemas
from tocsin.functions import scalar

EVENTS = schemas.struct(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
# Known shapes spare a look into the files before each query.
_SHAPES = {
    "events": EVENTS,
    "orders": schemas.struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": schemas.struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": schemas.struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "nation": schemas.struct("n_nationkey int, n_name string, n_regionkey int"),
    "region": schemas.struct("r_regionkey int, r_name string"),
}
_ZONES = ["North", "South", "East", "West", "Central"]
_SEVERITIES = ["Low", "medium", "HIGH", "Critical", " critical ", "low", "unknown", None]

INCIDENTS_SQL = """
incidents AS (
  SELECT CAST(event_id AS VARCHAR) AS incident_id,
         ts AS "timestamp",
         event_type AS incident_type,
         CASE user_id % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East'
                          WHEN 3 THEN 'West' ELSE 'Central' END AS zone,
         CASE k % 8 WHEN 0 THEN 'Low' WHEN 1 THEN 'medium' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'Critical'
                    WHEN 4 THEN ' critical ' WHEN 5 THEN 'low' WHEN 6 THEN 'unknown' END AS severity,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k = 99 THEN -value * 24 ELSE value * 24 END AS response_time,
         'UNIT-' || (user_id % 7) AS unit_id,
         'HOSP-' || (user_id % 3) AS hospital_id,
         'USER-' || user_id AS alert_key
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
)"""

# As alerts the same rows carry lower-case severities, so that filters on the
# exact word "critical" find some.
ALERTS_SQL = f"""{INCIDENTS_SQL},
alerts AS (
  SELECT incident_id, "timestamp", incident_type, zone, lower(severity) AS severity,
         response_time, unit_id, hospital_id, alert_key,
         CASE WHEN lower(severity) = 'critical' THEN 'Critical' ELSE 'Standard' END AS priority
  FROM incidents
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(_SHAPES[name]) if name in _SHAPES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def to_incidents(events: DataFrame) -> DataFrame:
    # props is a flat object; a filter repeats this expression, so it should be cheap.
    k = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).try_cast("int")
    seconds = F.col("value") * 24
    zones = F.array(*[F.lit(z) for z in _ZONES])
    severities = F.array(*[F.lit(s) for s in _SEVERITIES])
    return events.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("incident_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("incident_type"),
        F.get(zones, (F.col("user_id") % 5).cast("int")).alias("zone"),
        F.get(severities, F.col("k") % 8).alias("severity"),
        F.when(F.col("k") % 10 == 0, None)
        .when(F.col("k") == 99, -seconds)
        .otherwise(seconds)
        .alias("response_time"),
        F.concat(F.lit("UNIT-"), F.col("user_id") % 7).alias("unit_id"),
        F.concat(F.lit("HOSP-"), F.col("user_id") % 3).alias("hospital_id"),
        F.concat(F.lit("USER-"), F.col("user_id")).alias("alert_key"),
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_incidents(table(spark, sf_dir, "events")).drop("alert_key")


def to_alerts(events: DataFrame) -> DataFrame:
    """Alert payloads with ISO text times, plus ``alert_key``."""
    return (
        to_incidents(events)
        .withColumn("severity", F.lower("severity"))
        .withColumn("timestamp", scalar.iso_text("timestamp"))
        .withColumn("priority", scalar.priority_label("severity"))
    )


def large_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` in the shape of the large incident file."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_returnflag") == "A", "critical")
        .when(F.col("l_returnflag") == "N", "medium")
        .otherwise("low")
        .alias("severity"),
        F.col("l_linenumber").alias("zone_id"),
        F.col("l_extendedprice").alias("response_time"),
    )


LARGE_SQL = """
large_incidents AS (
  SELECT l_orderkey AS incident_id, l_shipdate AS "timestamp",
         CASE l_returnflag WHEN 'A' THEN 'critical' WHEN 'N' THEN 'medium' ELSE 'low' END AS severity,
         l_linenumber AS zone_id, l_extendedprice AS response_time
  FROM lineitem
)"""


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as incidents: complete rows with unique keys."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("incident_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderstatus").alias("zone"),
        F.col("o_orderpriority").alias("severity"),
        F.col("o_totalprice").alias("response_time"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as zones, nations as districts."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("zone"), F.col("n_name").alias("district")
    )


def crews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as units, stationed in their nation."""
    customer = table(spark, sf_dir, "customer")
    at = places(spark, sf_dir)
    return customer.join(at, customer.c_nationkey == at.n_nationkey).select(
        "c_custkey",
        F.col("c_name").alias("unit_name"),
        F.col("c_mktsegment").alias("unit_type"),
        F.col("district").alias("base_station"),
        "zone",
        "district",
    )
