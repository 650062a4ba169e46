import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from tocsin.operators import layout, ranking, reports


def test_zone_analysis_equals_pandas(incidents):
    pdf = incidents.toPandas()
    pdf = pdf[pdf["response_time"] < 3600]
    pdf["mins"] = pdf["response_time"] / 60
    expected = pdf.groupby("zone", dropna=False).agg(
        n=("incident_id", "count"), avg=("mins", "mean"), top=("mins", "max")
    )
    got = {r[0]: r[1:] for r in reports.zone_analysis(incidents).collect()}
    assert len(got) == len(expected)
    for zone, row in expected.iterrows():
        key = None if zone != zone or zone is None else zone
        assert got[key] == pytest.approx((row["n"], row["avg"], row["top"]))
    means = [r["avg_response_mins"] for r in reports.zone_analysis(incidents).collect()]
    assert means == sorted(means)


def test_sql_and_frame_reports_agree(incidents):
    frame = {r["zone"]: (r["total_incidents"], round(r["avg_response_mins"], 2)) for r in reports.zone_analysis(incidents).collect()}
    assert {r["zone"]: (r["total"], r["avg_mins"]) for r in reports.zone_sql(incidents).collect()} == frame


def test_aggregate_by_zone_leaves_null_zone_out(incidents):
    assert {r["zone"] for r in reports.aggregate_by_zone(incidents).collect()} == {"North", "South", "East"}


def test_critical_case_rules(incidents):
    assert rows_of(reports.critical_by_zone(incidents), "zone", "total") == [("North", 2)]
    exact = {r["zone"]: r["critical_count"] for r in reports.dashboard(incidents).collect()}
    folded = {r["zone"]: r["critical_count"] for r in reports.dashboard(incidents, ignore_case=True).collect()}
    assert exact["North"] == 1 and folded["North"] == 2
    assert rows_of(reports.critical_only(incidents), "incident_id") == [("a2",)]


def test_dashboard_order(incidents):
    assert [r["zone"] for r in reports.dashboard(incidents).collect()] == ["East", "North", "South", None]


def test_alert_stats_counts_missing_as_unknown(incidents):
    stats = {(r["dimension"], r["value"]): r["alerts"] for r in reports.alert_stats(incidents).collect()}
    assert stats[("severity", "unknown")] == stats[("zone", "unknown")] == stats[("incident_type", "unknown")] == 1
    for dimension in ("severity", "zone", "incident_type"):
        assert sum(n for (d, _), n in stats.items() if d == dimension) == 8


def test_dispatch_shows_missing_fields(spark):
    df = spark.createDataFrame(
        [("x", "critical", None, "North", "HOSP-A"), ("y", "low", "U", "North", "H")],
        "incident_id string, severity string, unit_id string, zone string, hospital_id string",
    )
    assert rows_of(reports.dispatches(df)) == [("x", "CRITICAL ALERT - Dispatching None to North Zone -> HOSP-A")]


def brute_rank(values):
    def smaller(a, b):
        return b is not None and (a is None or a < b)

    return sorted(
        ((v, 1 + sum(smaller(w, v) for w in values)) for v in values),
        key=lambda r: (r[0] is not None, r),
    )


@pytest.mark.parametrize("buckets", [2, 8, 256])
@pytest.mark.parametrize(
    "values",
    [
        [],
        [None, None],
        [5.0],
        [1.0] * 40,
        [1.0] * 30 + [float(i) for i in range(60)] + [None] * 5,
        [random.Random(7).gauss(0, 1) for _ in range(300)],
        [-0.0, 0.0, 1.0],
    ],
    ids=["empty", "nulls", "one", "all tied", "hot value", "spread", "signed zero"],
)
def test_rank_equals_brute_force(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = ranking.rank_by(df, "v", "r", buckets)
    assert rows_of(ranked) == [tuple(r) for r in sorted(brute_rank(values), key=lambda r: [(x is not None, str(x)) for x in r])]


def test_rank_zones_matches_window(spark, incidents):
    incidents.createOrReplaceTempView("inc")
    expected = spark.sql(
        "SELECT zone, avg_time, CAST(rank() OVER (ORDER BY avg_time) AS BIGINT) "
        "FROM (SELECT zone, avg(response_time) AS avg_time FROM inc GROUP BY zone)"
    )
    assert rows_of(reports.rank_zones(incidents)) == rows_of(expected)


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_numbered_keys_are_dense_and_repeatable(spark, buckets):
    rows = [(f"k{i % 500}", None if i % 500 == 3 else i % 500) for i in range(2000)] + [(None, None)] * 700
    df = spark.createDataFrame(rows, "a string, b int")
    first = rows_of(ranking.number_keys(df, "id", buckets), "id", "a", "b")
    again = rows_of(ranking.number_keys(df.repartition(7, F.rand(1)), "id", buckets), "id", "a", "b")
    assert first == again
    assert sorted(r[0] for r in first) == list(range(1, 502))


def test_strict_layout_never_splits_a_key(spark):
    df = spark.range(3000).select((F.col("id") % 5).alias("zone_id"))
    placed = layout.partition_rows(layout.partition_by_key(df, "zone_id", strict=True), "zone_id")
    assert rows_of(placed.groupBy("zone_id").count(), "count") == [(1,)] * 5


def test_rebalance_splits_a_hot_key_and_keeps_all_rows(spark, path):
    hot = spark.range(400000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("zone_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    out = path()
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1MB")
    try:
        placed = layout.partition_by_key(hot, "zone_id")
        placed.withColumn("p", F.spark_partition_id()).write.parquet(out)
    finally:
        spark.conf.unset(setting)
    per_key = spark.read.parquet(out).groupBy("zone_id").agg(
        F.count_distinct("p").alias("parts"), F.count("pad").alias("n")
    )
    by_key = {r["zone_id"]: r for r in per_key.collect()}
    assert by_key[0]["parts"] > 1
    assert sum(r["n"] for r in by_key.values()) == 400000


def test_cached_frame_is_freed(spark):
    df = spark.range(10)
    with layout.cached(df) as kept:
        assert kept.count() == 10 and kept.is_cached
    assert not df.is_cached
