"""Record shapes. Times are TIMESTAMP in a UTC session unless a table says otherwise."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "map": T.MapType(T.StringType(), T.StringType()),
    "bigints": T.ArrayType(T.LongType()),
}


def struct(spec: str) -> T.StructType:
    """Schema from ``"name type, ..."``, usable before a session exists."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_INCIDENT = struct(
    "incident_id string, timestamp timestamp, incident_type string, severity string, zone string, "
    "latitude double, longitude double, response_time double"
)
# Message payload: the event time travels as ISO text.
ALERT = struct(
    "incident_id string, timestamp string, incident_type string, zone string, severity string, "
    "response_time double, unit_id string, hospital_id string, priority string"
)
MESSAGE = struct("key string, value binary, timestamp timestamp")
STORED_ALERT = struct(
    "incident_id string, timestamp string, zone string, severity string, response_time double, "
    "unit_id string, hospital_id string"
)
ALERT_COUNT = struct("dimension string, value string, alerts bigint")

FACT_INCIDENTS = struct(
    "incident_id string, time_id bigint, location_id bigint, unit_id bigint, severity_id bigint, "
    "response_time_seconds double, outcome string"
)
DIM_TIME = struct("time_id bigint, date date, hour int, day_of_week string, is_weekend int")
DIM_LOCATION = struct(
    "location_id bigint, zone string, district string, city string, lat double, lon double"
)
DIM_UNIT = struct("unit_id bigint, unit_name string, unit_type string, base_station string")
DIM_SEVERITY = struct("severity_id bigint, severity string")
