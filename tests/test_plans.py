"""What Spark makes of the operators. Plans are read from ``explain`` text."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR
from tocsin.operators import clean, layout, quality, ranking, reports, star
from tocsin.operators.snapshots import SnapshotTable
from tocsin.sources import standin


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def large(spark):
    return standin.large_incidents(spark, SF_DIR)


@pytest.fixture
def lineitem(spark):
    return standin.table(spark, SF_DIR, "lineitem")


def test_range_filter_reaches_the_scan(large):
    text = plan(clean.below(large).select("incident_id"))
    assert "LessThan(l_extendedprice,3600.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_reports_aggregate_before_the_shuffle(large):
    text = plan(reports.zone_analysis(large, zone="zone_id"))
    assert text.count("HashAggregate") >= 2 and "partial_avg" in text
    assert "hashpartitioning(zone_id" in text
    assert "Python" not in text


@pytest.mark.parametrize("operator", [clean.impute_mean, clean.minmax_scale, clean.zscore_outliers])
def test_table_statistics_need_no_join_and_no_window(large, operator):
    main, _, subqueries = plan(operator(large)).partition("===== Subqueries =====")
    assert "Exchange" not in main and "Join" not in main and "Window" not in main
    assert "partial_" in subqueries
    assert "ReadSchema: struct<l_extendedprice:double>" in subqueries


def test_quality_report_joins_nothing(lineitem):
    rules = quality.Rules(required=["l_orderkey"], key=["l_orderkey"], value="l_extendedprice")
    text = plan(quality.report(lineitem, rules))
    assert "Join" not in text and "Window" not in text


def test_duplicates_count_before_the_shuffle(lineitem):
    text = plan(quality.duplicate_count(lineitem, ["l_orderkey", "l_linenumber"]))
    assert "partial_count(1)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_rank_orders_no_rows_in_one_task(lineitem):
    means = lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_time"))
    ranked = ranking.rank_by(means, "avg_time", "r")
    ranked.collect()
    text = ranked._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    # The one gathered input is the per-bucket weight.
    for found in re.finditer(r"SinglePartition.*\n.*", final):
        assert "_bucket" in found.group(0) or "percentile_approx" in found.group(0)
    assert "ReusedExchange" in final


def test_numbered_keys_meet_in_buckets_only(lineitem):
    text = plan(ranking.number_keys(lineitem.select("l_partkey"), "id"))
    windows = re.findall(r"Arguments: \[(?:row_number|sum)\(.*", text)
    assert windows and all("_bucket" in w for w in windows)


def test_lookup_carries_no_broadcast_hint(spark, lineitem):
    dim = star.dim_unit(lineitem.select(F.col("l_partkey").cast("string").alias("unit_name")))
    joined = star.lookup(
        lineitem.withColumn("unit_name", F.col("l_partkey").cast("string")), dim, "unit_id", unit_name="unit_name"
    )
    logical = joined._jdf.queryExecution().analyzed().toString()
    hints = [line for line in logical.splitlines() if "ResolvedHint" in line]
    # Only the per-bucket offsets are hinted.
    assert len(hints) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_read_lists_only_its_parts(spark, path):
    table = SnapshotTable(spark, path("lake"))
    table.overwrite(spark.range(3))
    table.append(spark.range(3))
    table.overwrite(spark.range(5))
    folders = {re.search(r"snapshot_version=(\d+)", f)[1] for f in table.read(1).inputFiles()}
    assert folders == {"0", "1"} and table.read(1).count() == 6


def test_top_rows_keep_n_per_task(large):
    assert "TakeOrderedAndProject" in plan(reports.top_rows(large, 5, "response_time"))


def test_hot_unit_is_split_in_the_shuffled_lookup(spark):
    rows = spark.range(0, 200000, numPartitions=8)
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500))
    facts = rows.select(F.col("id").alias("incident_id"), hot.alias("unit_name"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    dim = star.dim_unit(facts.select("unit_name"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = star.lookup(facts, dim, "unit_id", unit_name="unit_name")
        assert joined.filter("unit_id IS NOT NULL AND pad IS NOT NULL").count() == 200000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for key in small:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in final


def test_cached_frame_is_read_from_memory(spark, large):
    with layout.cached(reports.critical_only(large)) as critical:
        critical.count()
        found = reports.global_average(critical)
        assert "InMemoryTableScan" in plan(found) and found.first()["total"] == critical.count()
    assert not critical.is_cached
    assert "InMemoryTableScan" not in plan(reports.global_average(reports.critical_only(large)))


def test_quality_report_scans_three_times(spark, lineitem):
    rules = quality.Rules(required=["l_orderkey", "l_quantity"], key=["l_orderkey"], value="l_quantity")
    found = quality.report(lineitem, rules)
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    whole = re.sub(r"Reused\w+ .*", "", final)
    scans = set(re.findall(r"FileScan parquet \[[^\]]*\]", whole))
    assert len(re.findall(r"FileScan parquet", whole)) <= 3 + whole.count("ReusedSubquery") and len(scans) <= 3
