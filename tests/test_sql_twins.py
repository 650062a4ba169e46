"""Queries against their SQL on rows that the given tables lack."""

from datetime import datetime, timedelta

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tocsin.sources import standin


def equal_to_sql(spark, folder, name, table, rows):
    """Write the rows as the table, run the query and its SQL twin over it, compare."""
    spark.createDataFrame(rows, standin._SHAPES[table]).write.parquet(f"{folder}/{table}.parquet")
    df = driver.queries()[name](spark, folder)
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        answer = duck.execute(driver.oracle_sql()[name])
        columns = [c[0] for c in answer.description]
        expected = answer.fetchall()
    found = [tuple(row) for row in df.select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    return found


def test_a_mean_just_below_a_half_is_rounded_as_in_sql(spark, path):
    quantities = {1: [17.0] * 39 + [18.0], 2: [17.02], 3: [17.03], 4: [50.0, 0.25], 5: [None]}
    rows = [(n, part, 1, n, q, 1.0, 0.0, 0.0, "N", "O", None) for part, qs in quantities.items() for n, q in enumerate(qs)]
    found = equal_to_sql(spark, path("sf"), "zone_rank_large", "lineitem", rows)
    # 681 / 40 = 17.025, which as a double is less
    assert (1, 17.02, 2) in found and (2, 17.02, 2) in found


def test_many_distinct_keys_are_counted_exactly(spark, path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=i % 7200), (i * 7) % 2750, "click", 1.0, '{"k": 5}') for i in range(6000)]
    found = equal_to_sql(spark, path("sf"), "zone_variety_hourly", "events", rows)
    assert {r[1]: r[3] for r in found}["whole day"] == 2750


def test_parts_hold_each_row_once_when_percentiles_vary(spark, path, monkeypatch):
    # As on several executors, where partial results are merged in the order they come.
    def varying(value, share):
        now = F.unix_micros(F.current_timestamp()) * 1009
        cut = F.min(value) + F.pmod(now, F.max(value) - F.min(value))
        return F.array(cut, F.lit(2**62)) if isinstance(share, list) else cut

    monkeypatch.setattr(F, "percentile_approx", varying)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=3 * i), i % 1000, ("click", "error")[i % 2], 1.0, '{"k": 5}') for i in range(2000)]
    equal_to_sql(spark, path("sf"), "stream_settled", "events", rows)
    equal_to_sql(spark, path("sf"), "upsert_stored", "events", rows)
