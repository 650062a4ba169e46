"""Star schema: dimensions with integer ids and a fact table that refers to them.

Lookups are plain equi-joins. Spark broadcasts a dimension only if its measured
size allows it and shuffles otherwise, splitting keys that hold too many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin import schemas
from tocsin.functions import scalar
from tocsin.operators.ranking import number_keys
from tocsin.operators.tables import add_missing


def dim_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row per calendar hour that occurs."""
    t = F.col("_hour")
    hours = df.filter(F.col(ts).isNotNull()).select(F.date_trunc("hour", ts).alias("_hour")).distinct()
    return hours.select(
        scalar.hour_key(t).alias("time_id"),
        F.to_date(t).alias("date"),
        F.hour(t).alias("hour"),
        F.date_format(t, "EEEE").alias("day_of_week"),
        F.dayofweek(t).isin(1, 7).cast("int").alias("is_weekend"),
    )


def natural(df: DataFrame, shape) -> DataFrame:
    """The dimension's columns without its id, typed; those the source lacks are null."""
    full = add_missing(_known(df, shape), shape)
    return full.select(*[F.col(f.name).cast(f.dataType) for f in shape if not f.name.endswith("_id")])


def dim_location(df: DataFrame) -> DataFrame:
    """Places by zone and whatever finer columns the source has."""
    return number_keys(natural(df, schemas.DIM_LOCATION), "location_id")


def dim_unit(df: DataFrame) -> DataFrame:
    return number_keys(natural(df, schemas.DIM_UNIT), "unit_id")


def dim_severity(df: DataFrame) -> DataFrame:
    """The declared fact refers to a severity that no declared dimension holds."""
    return number_keys(natural(df, schemas.DIM_SEVERITY), "severity_id")


def added(df: DataFrame, dim: DataFrame, id_name: str, greatest: int) -> DataFrame:
    """Rows of ``df`` that the dimension lacks, numbered from ``greatest + 1`` without
    gaps. Ids that are given out stay: only new rows are numbered. Nulls equal nulls."""
    columns = [c for c in dim.columns if c != id_name]
    held = dim.select(*[F.col(c).alias(f"_dim_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_dim_{c}"))
    new = number_keys(df.select(*columns).distinct().join(held, same, "left_anti"), id_name)
    return new.withColumn(id_name, F.col(id_name) + greatest)


def _known(df: DataFrame, shape) -> DataFrame:
    """The dimension's natural columns; coordinates also under their long names."""
    for short, long in (("lat", "latitude"), ("lon", "longitude")):
        if short in shape.names and short not in df.columns and long in df.columns:
            df = df.withColumnRenamed(long, short)
    return df.select(*[c for c in df.columns if c in shape.names and not c.endswith("_id")])


def lookup(df: DataFrame, dim: DataFrame, id_name: str, **on: Column | str) -> DataFrame:
    """Add ``id_name`` from ``dim``. ``on`` maps a dimension column to a column of
    ``df``; nulls match nulls. Rows without a match stay and get a null id."""
    keys = dim.select(F.col(id_name), *[F.col(c).alias(f"_dim_{c}") for c in on])
    condition = F.lit(True)
    for c, source in on.items():
        condition = condition & scalar.column(source).eqNullSafe(F.col(f"_dim_{c}"))
    return df.join(keys, condition, "left").drop(*[f"_dim_{c}" for c in on])


def with_ids(
    facts: DataFrame,
    tables: dict[str, DataFrame],
    places: DataFrame,
    units: DataFrame,
    crews: DataFrame | None = None,
    on: tuple[str, str] | None = None,
    severity: str = "severity",
) -> DataFrame:
    """Facts with the ids of the dimensions in ``tables``.

    ``places`` and ``units`` hold the natural columns of the dimensions. Facts either
    hold them too, or refer by ``on`` (fact column, crew column) to ``crews``, which do.
    Then ids are looked up on the crews, the smaller side, and the facts are shuffled
    for one join only.
    """
    holder = facts if crews is None else crews
    by_place = [c for c in ("zone", "district", "city", "lat", "lon") if c in places.columns]
    by_unit = [c for c in ("unit_name", "unit_type", "base_station") if c in units.columns]
    placed = lookup(holder, tables["dim_location"], "location_id", **{c: c for c in by_place})
    placed = lookup(placed, tables["dim_unit"], "unit_id", **{c: c for c in by_unit})
    if crews is not None:
        fact_column, crew_column = on
        repeated = crews.groupBy(crew_column).count().filter(F.col("count") > 1)
        if not repeated.filter(F.col(crew_column).isNotNull()).isEmpty():
            raise ValueError(f"{crew_column} repeats among the crews, so facts would multiply")
        ids = placed.select(F.col(crew_column).alias("_crew"), "location_id", "unit_id")
        placed = facts.join(ids, F.col(fact_column) == F.col("_crew"), "left")
    return lookup(placed, tables["dim_severity"], "severity_id", severity=severity)


def fact(
    df: DataFrame,
    key: str = "incident_id",
    ts: str = "timestamp",
    seconds: str = "response_time",
    outcome: Column | str | None = None,
) -> DataFrame:
    """Fact rows from a frame that already carries its looked-up ids."""
    ended = F.lit(None) if outcome is None else scalar.column(outcome)
    return df.select(
        F.col(key).cast("string").alias("incident_id"),
        scalar.hour_key(ts).alias("time_id"),
        "location_id",
        "unit_id",
        "severity_id",
        F.col(seconds).cast("double").alias("response_time_seconds"),
        ended.cast("string").alias("outcome"),
    )


def named(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with what their ids stand for."""
    out = tables["fact_incidents"]
    for dim, id_name in (
        ("dim_location", "location_id"),
        ("dim_unit", "unit_id"),
        ("dim_severity", "severity_id"),
        ("dim_time", "time_id"),
    ):
        out = out.join(tables[dim], id_name, "left")
    return out
