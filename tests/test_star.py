from datetime import date, datetime

import pytest

from helpers import rows_of
from pyspark.sql import functions as F

from tocsin import schemas
from tocsin.operators import star
from tocsin.plans import jobs


def test_time_dimension(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 4, 17, 11, 59),), (datetime(2026, 4, 17, 11, 1),), (datetime(2026, 4, 19, 0, 0),), (None,)],
        "timestamp timestamp",
    )
    assert rows_of(star.dim_time(df)) == [
        (2026041711, date(2026, 4, 17), 11, "Friday", 0),
        (2026041900, date(2026, 4, 19), 0, "Sunday", 1),
    ]
    assert star.dim_time(df).schema.names == schemas.DIM_TIME.names


def test_dimensions_have_the_declared_shape(spark):
    df = spark.createDataFrame([("East", "U1", "low")], "zone string, unit_name string, severity string")
    for build, shape in (
        (star.dim_location, schemas.DIM_LOCATION),
        (star.dim_unit, schemas.DIM_UNIT),
        (star.dim_severity, schemas.DIM_SEVERITY),
    ):
        dim = build(df)
        assert [(f.name, f.dataType) for f in dim.schema] == [(f.name, f.dataType) for f in shape]
        assert dim.count() == 1


def _facts(spark):
    t = datetime(2026, 4, 17, 11, 14)
    rows = [(f"i{n}", t, ["East", "West", None][n % 3], f"U{n % 4}", "low" if n % 3 else None, float(n)) for n in range(60)]
    return spark.createDataFrame(
        rows, "incident_id string, timestamp timestamp, zone string, unit_name string, severity string, response_time double"
    )


def test_every_fact_key_finds_its_dimension_row(spark, path):
    df = _facts(spark)
    loaded = jobs.load_star(df, path("star"), places=df.select("zone"), units=df.select("unit_name"))
    fact = loaded["fact_incidents"]
    assert fact.count() == 60
    assert fact.schema.names == schemas.FACT_INCIDENTS.names
    for dim, key in (("dim_time", "time_id"), ("dim_location", "location_id"), ("dim_unit", "unit_id"), ("dim_severity", "severity_id")):
        assert fact.filter(F.col(key).isNull()).count() == 0
        assert fact.join(loaded[dim], key, "left_anti").count() == 0
        assert loaded[dim].count() == loaded[dim].select(key).distinct().count()
    back = star.named(loaded)
    assert rows_of(back, "incident_id", "zone", "unit_name", "severity") == rows_of(
        df, "incident_id", "zone", "unit_name", "severity"
    )


def test_fact_without_match_keeps_its_row(spark):
    df = _facts(spark)
    dim = star.dim_unit(df.filter("unit_name <> 'U3'"))
    found = star.lookup(df, dim, "unit_id", unit_name="unit_name")
    assert found.count() == 60
    assert found.filter("unit_id IS NULL").count() == 15


def test_repeated_crew_is_refused(spark, path):
    facts = spark.createDataFrame([("i1", None, "low", 5.0, 1)], "incident_id string, timestamp timestamp, severity string, response_time double, crew int")
    crews = spark.createDataFrame([(1, "North", "u1"), (1, "North", "u2")], "id int, zone string, unit_name string")
    with pytest.raises(ValueError, match="repeats"):
        jobs.load_star(facts, path(), crews.select("zone"), crews.select("unit_name"), crews, ("crew", "id"))


def test_long_names_of_coordinates(spark):
    df = spark.createDataFrame([("North", 40.5, -74.0)], "zone string, latitude double, longitude double")
    row = star.dim_location(df).first()
    assert (row["zone"], row["lat"], row["lon"]) == ("North", 40.5, -74.0)
