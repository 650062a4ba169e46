from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from tocsin import schemas
from tocsin.operators import star
from tocsin.operators.star_store import StarStore

FACTS = "incident_id string, timestamp timestamp, zone string, unit_name string, severity string, response_time double"


def facts(spark, numbers, hour=11):
    t = datetime(2026, 4, 17, hour, 14)
    rows = [(f"i{n}", t, [None, "East", "West"][n % 3], f"U{n % 7}", "low" if n % 2 else None, float(n)) for n in numbers]
    return spark.createDataFrame(rows, FACTS)


def load(store, df, run_id, **more):
    return store.load(df, run_id, places=df.select("zone"), units=df.select("unit_name"), **more)


@pytest.fixture
def store(spark, path):
    return StarStore(spark, path("star"))


def ids(store, name, up_to=None):
    return {tuple(r)[1:]: tuple(r)[0] for r in store.tables(up_to)[name].collect()}


def test_facts_of_all_loads_join_to_their_names(spark, store):
    parts = [facts(spark, range(3), 11), facts(spark, range(3, 40), 12), facts(spark, range(40, 60), 11)]
    assert [load(store, df, f"r{k}") for k, df in enumerate(parts)] == [0, 1, 2]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    tables = store.tables()
    assert rows_of(star.named(tables), "incident_id", "zone", "unit_name", "severity") == rows_of(whole, "incident_id", "zone", "unit_name", "severity")
    for name, shape in (("dim_location", schemas.DIM_LOCATION), ("dim_unit", schemas.DIM_UNIT), ("dim_severity", schemas.DIM_SEVERITY)):
        found = ids(store, name)
        assert tables[name].schema.names == shape.names
        assert sorted(found.values()) == list(range(1, len(found) + 1)) and tables[name].count() == len(found)
        for earlier in (0, 1):
            assert ids(store, name, earlier).items() <= found.items()
    assert tables["dim_time"].count() == 2
    assert star.named(store.tables(up_to=0)).count() == 3


def test_only_what_is_new_is_written(spark, store):
    load(store, facts(spark, range(40)), "first")
    before = {name: set(df.inputFiles()) for name, df in store.tables().items()}
    load(store, facts(spark, range(100, 120)), "second")
    after = {name: set(df.inputFiles()) for name, df in store.tables().items()}
    for name in before:
        assert before[name] <= after[name]
        assert (after[name] == before[name]) == (name != "fact_incidents")
    second = store.loads().filter("run_id = 'second'").first()
    assert second["rows"] == {"dim_location": 0, "dim_unit": 0, "dim_severity": 0, "dim_time": 0, "fact_incidents": 20}


def test_a_run_is_loaded_once_and_a_failed_load_is_replaced(spark, store, monkeypatch):
    load(store, facts(spark, range(5)), "first")
    plain = StarStore._write

    def broken(self, name, number, df):
        if name == "fact_incidents":
            raise OSError("lost")
        return plain(self, name, number, df)

    monkeypatch.setattr(StarStore, "_write", broken)
    with pytest.raises(OSError):
        load(store, facts(spark, range(5, 30)), "second")
    monkeypatch.undo()
    assert star.named(store.tables()).count() == 5 and store.tables()["dim_unit"].count() == 5
    other = facts(spark, range(5, 8)).withColumn("unit_name", F.concat(F.lit("other "), "unit_name"))
    assert load(store, other, "third") == 1 == load(store, other, "third")
    assert load(store, facts(spark, range(5, 30)), "second") == 2
    assert load(store, facts(spark, range(5)), "first") == 0
    found = ids(store, "dim_unit")
    assert sorted(found.values()) == list(range(1, 11)) and star.named(store.tables()).count() == 33


def test_unique_facts(spark, store):
    load(store, facts(spark, range(5)), "first")
    again = facts(spark, [3, 4, 5], 12).unionByName(facts(spark, [5], 13)).withColumn("response_time", F.lit(-1.0))
    nameless = facts(spark, [1, 1]).withColumn("incident_id", F.lit(None).cast("string"))
    load(store, again.unionByName(nameless), "second", unique=True)
    got = store.tables()["fact_incidents"]
    assert got.filter("incident_id IS NULL").count() == 2
    assert rows_of(got.filter("incident_id IS NOT NULL"), "incident_id", "time_id")[-2:] == [("i4", 2026041711), ("i5", 2026041713)]
    assert got.filter("response_time_seconds = -1").count() == 1


def test_empty_loads(spark, store):
    assert all(df.count() == 0 for df in store.tables().values())
    assert load(store, facts(spark, range(3)).limit(0), "none") == 0
    assert all(df.count() == 0 for df in store.tables().values())
    load(store, facts(spark, range(3)), "some")
    assert star.named(store.tables()).count() == 3


def test_nulls_and_repeated_rows_find_their_dimension_row(spark):
    dim = spark.createDataFrame([(4, "East", None, None, None, None)], schemas.DIM_LOCATION)
    rows = spark.createDataFrame([("East",), ("East",), (None,), (None,), ("West",)], "zone string")
    new = star.added(star.natural(rows, schemas.DIM_LOCATION), dim, "location_id", 4)
    assert sorted(r["location_id"] for r in new.collect()) == [5, 6]
    assert {r["zone"] for r in new.collect()} == {None, "West"}
