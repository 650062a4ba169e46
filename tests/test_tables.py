from datetime import datetime

import pytest

from helpers import SCHEMA, rows_of
from tocsin import schemas
from tocsin.operators import tables
from tocsin.sources import files, messages


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "old")], "k string, o int, v string")


def test_upsert_last_arrival_wins(spark, target):
    batch = spark.createDataFrame(
        [("a", 2, "first"), ("a", 3, "last"), ("c", 2, "new"), (None, 2, "n1"), (None, 2, "n1")],
        "k string, o int, v string",
    )
    got = tables.upsert(target, batch, ["k"], ["o"])
    assert rows_of(got, "k", "v") == [
        (None, "n1"), (None, "n1"), (None, "old"), ("a", "last"), ("b", "old"), ("c", "new"),
    ]
    keyed = batch.filter("k IS NOT NULL")
    once = tables.upsert(target, keyed, ["k"], ["o"])
    assert rows_of(tables.upsert(once, keyed, ["k"], ["o"])) == rows_of(once)


def test_upsert_with_order_column_outside_the_target(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    batch = spark.createDataFrame([("a", "late", 9), ("a", "early", 1)], "k string, v string, pos int")
    assert rows_of(tables.upsert(target, batch, ["k"], ["pos"])) == [("a", "late")]


def test_latest_does_not_depend_on_placement(spark):
    df = spark.createDataFrame([("a", 1, f"v{i}") for i in range(50)], "k string, o int, v string")
    results = {rows_of(tables.latest_per_key(df.repartition(n), ["k"], ["o"]))[0] for n in (1, 3, 7)}
    assert results == {("a", 1, "v9")}


def test_latest_keeps_nulls_of_the_last_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, o int, v string")
    assert rows_of(tables.latest_per_key(df, ["k"], ["o"])) == [("a", 2, None)]


def test_evolve_and_add_missing(spark):
    old = spark.createDataFrame([("a", "North")], "incident_id string, zone string")
    new = spark.createDataFrame([("b", "East", "U1")], "incident_id string, zone string, unit_id string")
    assert rows_of(tables.evolve(old, new)) == [("a", "North", None), ("b", "East", "U1")]
    widened = tables.add_missing(old, schemas.STORED_ALERT)
    assert set(widened.columns) == set(schemas.STORED_ALERT.names)
    assert widened.schema["response_time"].dataType.simpleString() == "double"


def test_union_all_keeps_copies(spark):
    df = spark.range(3)
    assert tables.union_all(df, df, df).count() == 9


def test_row_changes_with_repeated_rows(spark):
    before = spark.createDataFrame([("a", 1)] * 3 + [("b", 1), (None, 1)], "k string, v int")
    after = spark.createDataFrame([("a", 1)] * 2 + [("b", 2), (None, 1)], "k string, v int")
    assert rows_of(tables.row_changes(before, after)) == [("a", 1, 3, 2), ("b", 1, 1, 0), ("b", 2, 0, 1)]


def test_append_run_can_be_repeated(spark, path):
    out = path()
    df = spark.createDataFrame([("a", 1.0)], "incident_id string, response_time double")
    files.append_run(df, out, "monday")
    files.append_run(df.union(df), out, "monday")
    files.append_run(df, out, "tuesday")
    assert rows_of(files.read_runs(spark, out, df.schema), "run_id") == [("monday",), ("monday",), ("tuesday",)]


def test_csv_round_trip_of_awkward_text(spark, path):
    t = datetime(2026, 4, 17, 11, 14, 46, 311553)
    rows = [
        ("1", t, 'say "hi", you', " padded ", None, 8.16798193569903),
        ("2", None, "back\\slash", "ünï", "West", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = path()
    files.write_csv(df, out)
    assert rows_of(files.read_csv(spark, out, df.schema)) == rows_of(df)
    inferred = files.read_csv(spark, out)
    assert inferred.schema["response_time"].dataType.simpleString() == "double"
    assert inferred.count() == 2


def test_csv_missing_texts_become_null(spark, path):
    out = path()
    text = "k,zone,v\na,NA,NaN\nb,West,5.5\nc,null,bad"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(out)
    shape = schemas.struct("k string, zone string, v double")
    got = files.read_csv(spark, out, shape, missing=files.MISSING_TEXTS)
    assert rows_of(got) == [("a", None, None), ("b", "West", 5.5), ("c", None, None)]


def test_csv_keeps_every_text_unless_told_otherwise(spark, path):
    out = path()
    df = spark.createDataFrame([("NA", "None", 1.0), ("x", "null", -2.5), ("y", "N/A", None)], "k string, s string, v double")
    files.write_csv(df, out)
    assert rows_of(files.read_csv(spark, out, df.schema)) == rows_of(df)


def test_csv_rows_that_do_not_fit_keep_their_text(spark, path):
    out = path()
    spark.createDataFrame([("k,v\na,1\nb,twelve",)], "value string").coalesce(1).write.text(out)
    got = files.read_csv(spark, out, schemas.struct("k string, v double"), corrupt="bad")
    assert rows_of(got) == [("a", 1.0, None), ("b", None, "b,twelve")]


def test_replacing_keeps_the_old_table_if_the_write_fails(spark, path):
    out = path()
    files.replace_table(spark.range(3), out)
    failing = spark.range(3).selectExpr("assert_true(id < 2) AS x", "id")
    with pytest.raises(Exception):
        files.replace_table(failing, out)
    assert spark.read.parquet(out).count() == 3
    files.replace_table(spark.range(5), out)
    assert spark.read.parquet(out).count() == 5


def test_json_log_appends_and_keeps_null_keys(spark, path, incidents):
    out = path()
    files.append_json_log(incidents, out)
    files.append_json_log(incidents, out)
    assert files.read_json_log(spark, out, incidents.schema).count() == 16
    assert all('"zone"' in r[0] for r in spark.read.text(out).collect())


def test_first_available(spark, path):
    missing, there = path(), path()
    spark.range(4).write.parquet(there)
    assert files.first_available(spark, [missing, there]).count() == 4
    assert files.first_available(spark, [missing]) is None


def test_encoded_messages_decode_to_the_same_rows(spark, incidents):
    from pyspark.sql import functions as F

    plain = incidents.drop("timestamp")
    sent = messages.encode(plain)
    assert sent.columns == ["key", "value"]
    assert [f.dataType.simpleString() for f in sent.schema] == ["string", "binary"]
    back = sent.select(F.from_json(F.col("value").cast("string"), plain.schema).alias("d")).select("d.*")
    assert rows_of(back) == rows_of(plain)
    assert messages.encode(plain, key=None).columns == ["value"]
    assert messages.encode(plain, ingest_time=F.current_timestamp()).columns == ["key", "value", "timestamp"]
