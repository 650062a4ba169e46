import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from tocsin.operators import tables
from tocsin.operators.keyed_store import KeyedTable

DDL = "k string, o long, v string"


@pytest.fixture
def store(spark, path):
    return KeyedTable(spark, path("keyed"), ["k"], buckets=8)


def files_of(store):
    return {f.split("/data/")[1] for f in store.read().inputFiles()}


def test_equals_the_plain_upsert(spark, store):
    pick, target = random.Random(4), None
    for batch in range(4):
        rows = [(pick.choice([None, *"abcdefghijkl"]), pick.randint(0, 9), f"v{batch}.{n}") for n in range(25)]
        df = spark.createDataFrame(rows, DDL)
        assert store.upsert(df, ["o"]) == batch
        target = df.limit(0) if target is None else target
        target = spark.createDataFrame(tables.upsert(target, df, ["k"], ["o"]).collect(), DDL)
        assert rows_of(store.read()) == rows_of(target)


def test_only_buckets_with_rows_are_rewritten(spark, store):
    store.upsert(spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("o"), F.lit("old").alias("v")), ["o"])
    before = files_of(store)
    store.upsert(spark.createDataFrame([("7", 2, "new"), ("7", 1, "less")], DDL), ["o"])
    after = files_of(store)
    assert {f.split("/")[1] for f in before} == {f"key_bucket={n}" for n in range(8)}
    moved = {f.split("/")[1] for f in after - before}
    assert len(moved) == 1 and {f.split("/")[1] for f in before - after} == moved
    assert store.read().filter("k = '7'").collect()[0]["v"] == "new" and store.read().count() == 200
    last = store.last()
    assert (last["inserted"], last["updated"]) == (0, 1) and 0 < last["kept"] < 100


def test_merge_is_done_once_and_a_failed_one_replaced(spark, store, monkeypatch):
    first = spark.createDataFrame([("a", 1, "x"), (None, 1, "n")], DDL)
    assert store.upsert(first, ["o"], run_id="1") == store.upsert(first, ["o"], run_id="1") == 0
    broken = spark.createDataFrame([("a", 2, "y"), ("b", 2, "y")], DDL)
    broken.withColumn("key_bucket", F.lit(3)).write.partitionBy("key_bucket").parquet(f"{store._data}/merge=1")
    assert rows_of(store.read()) == [(None, 1, "n"), ("a", 1, "x")]
    assert store.upsert(spark.createDataFrame([("c", 2, "z"), (None, 2, "m")], DDL), ["o"], run_id="2") == 1
    assert rows_of(store.read()) == [(None, 1, "n"), (None, 2, "m"), ("a", 1, "x"), ("c", 2, "z")]


def test_columns_may_be_added_and_absent(spark, store):
    store.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], DDL), ["o"])
    store.upsert(spark.createDataFrame([("a", 9, 0.5, 3)], "k string, pos long, extra double, o long"), ["pos"])
    assert rows_of(store.read().select("k", "o", "v", "extra")) == [("a", 3, None, 0.5), ("b", 1, "y", None)]
    assert "pos" not in store.read().columns


def test_vacuum_keeps_what_is_read(spark, store):
    for n in range(3):
        store.upsert(spark.createDataFrame([("a", n, f"v{n}"), (None, n, "n")], DDL), ["o"])
    before = rows_of(store.read())
    assert store.vacuum() == 2 and store.vacuum() == 0
    assert rows_of(store.read()) == before and len(before) == 4


def test_empty_batches_and_several_keys(spark, path):
    store = KeyedTable(spark, path("keyed"), ["k", "o"], buckets=2)
    assert store.read() is None
    empty = spark.createDataFrame([], DDL)
    store.upsert(empty, ["v"])
    assert store.read().count() == 0 and store.read().columns == ["k", "o", "v"]
    store.upsert(spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 1, "y"), ("a", None, "z")], DDL), ["v"])
    store.upsert(empty, ["v"])
    assert rows_of(store.read()) == [("a", None, "z"), ("a", 1, "y"), ("a", 2, "x")]
