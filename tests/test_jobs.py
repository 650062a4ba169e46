import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, rows_of
from tocsin.operators import clean, quality
from tocsin.plans import jobs
from tocsin.sources import files


@pytest.fixture
def good(spark):
    t = datetime(2026, 4, 17, 11, 14, 46, 311553)
    rows = [(f"i{n}", t, "Fire", ["Low", "CRITICAL"][n % 2], ["East", "West", "North"][n % 3], 2.0 + n) for n in range(30)]
    return spark.createDataFrame(rows, SCHEMA)


# Extremes, mean and scaled mean of the published sample.
LOW, HIGH, MEAN, SCALED_MEAN = 2.046032341495499, 14.818798763655114, 8.16798193569903, 0.4792970756579791


def test_clean_gives_the_published_values(spark, path):
    t = datetime(2026, 4, 17, 11, 14, 46, 311553)
    third = 3 * MEAN - LOW - HIGH
    rows = [(f"i{n}", t, "Fire", "Low", "East", v) for n, v in enumerate([LOW, HIGH, third, None, None])]
    stored = jobs.clean(spark.createDataFrame(rows, SCHEMA), path())
    got = {r["incident_id"]: r for r in stored.collect()}
    assert got["i3"]["response_time"] == pytest.approx(MEAN, rel=1e-14)
    assert got["i3"]["response_time_normalized"] == pytest.approx(SCALED_MEAN, rel=1e-12)
    assert (got["i0"]["response_time_normalized"], got["i1"]["response_time_normalized"]) == (0.0, 1.0)
    assert all(r["valid_severity"] for r in got.values())
    assert got["i0"]["timestamp"] == t


@pytest.mark.parametrize(
    "rows",
    [
        [("a", 1.0), ("b", None), (None, 99.0)],
        [("a", 1.0), ("b", 3.0), (None, 99.0)],
        [("a", None), (None, 99.0), (None, 1.0)],
        [(None, 5.0)],
        [("a", None)],
        [("a", 1.0), ("b", float("nan")), ("c", None), ("d", 3.0)],
        [("a", float("nan")), (None, 2.0)],
        [],
    ],
)
def test_one_pass_cleaning_equals_the_steps(spark, rows):
    df = spark.createDataFrame(rows, "incident_id string, response_time double").withColumn("severity", F.lit("low"))
    steps = clean.validate_in(clean.minmax_scale(clean.drop_null_key(clean.impute_mean(df))))
    assert rows_of(jobs.cleaned(df)) == rows_of(steps)


def test_etl_and_elt_differ_where_other_columns_are_null(spark, path, incidents):
    etl = jobs.etl(incidents, path())
    elt = jobs.elt(incidents, path(), path())
    assert etl.count() == len(incidents.toPandas().dropna())
    assert elt.count() == 7
    assert {"processed_at"} <= set(etl.columns) and {"clean_severity"} <= set(elt.columns)
    both = {r["table_name"]: r for r in jobs.compare(etl, elt).collect()}
    assert both["etl"]["total_rows"] == 3 and both["elt"]["total_rows"] == 7
    assert not both["etl"]["equivalent"]


def test_etl_and_elt_agree_on_complete_rows(spark, path, good):
    both = jobs.compare(jobs.etl(good, path()), jobs.elt(good, path(), path()))
    assert [r["equivalent"] for r in both.collect()] == [True, True]


def test_etl_takes_a_fixed_load_time(spark, path, good):
    now = datetime(2026, 1, 1)
    assert rows_of(jobs.etl(good, path(), F.lit(now)).select("processed_at").distinct()) == [(now,)]


def test_nightly_gate_stops_before_the_load(spark, path, incidents):
    root = path("nightly")
    with pytest.raises(quality.QualityError):
        jobs.nightly(incidents, root, "r1")
    assert files.exists(spark, f"{root}/extract")
    for name in ("transformed", "incidents", "lake"):
        assert not files.exists(spark, f"{root}/{name}")


def test_nightly_can_be_run_again(spark, path, good):
    root = path("nightly")
    for run_id in ("r1", "r1", "r2"):
        table = jobs.nightly(good, root, run_id)
    assert table.read().count() == 60
    assert [r["version"] for r in table.history().collect()] == [1, 0]
    loaded = jobs.nightly_loaded(spark, root, good.schema)
    assert loaded.groupBy("run_id").count().count() == 2 and loaded.count() == 60
    assert {r[0] for r in loaded.select("severity").distinct().collect()} == {"low", "critical"}


def test_capstone_reports_but_goes_on(spark, path, incidents):
    dashboard, passed = jobs.capstone(incidents, path("capstone"), "r1")
    assert passed is False
    assert {r["zone"]: r["incidents"] for r in dashboard.collect()} == {"North": 2, "South": 2, "East": 2, None: 1}


def test_capstone_on_good_rows(spark, path, good):
    dashboard, passed = jobs.capstone(good, path("capstone"), "r1")
    assert passed is True
    assert sum(r["critical_count"] for r in dashboard.collect()) == 15


def test_failed_csv_and_table_leave_the_old_content_alone(spark, path):
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    bad = spark.range(4).select(F.col("id").cast("int").alias("k"), F.raise_error(F.lit("lost")).cast("string").alias("v"))
    folder = path("out")
    spark.range(1).write.parquet(f"{folder}/keep")
    for write, read in ((files.write_csv, files.read_csv), (files.replace_table, lambda s, p, schema: s.read.schema(schema).parquet(p))):
        target = f"{folder}/{write.__name__}"
        write(good, target)
        with pytest.raises(Exception, match="lost"):
            write(bad, target)
        assert rows_of(read(spark, target, good.schema)) == [(1, "a")]
        write(good.unionByName(good), target)
        assert read(spark, target, good.schema).count() == 2
    assert sorted(os.listdir(folder)) == ["keep", "replace_table", "write_csv"]
