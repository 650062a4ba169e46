import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, rows_of
from tocsin.functions import scalar
from tocsin.operators import clean


def values(df, column="response_time"):
    return [r[0] for r in df.select(column).collect()]


def test_impute_mean_equals_pandas(incidents):
    expected = incidents.toPandas()["response_time"]
    expected = expected.fillna(expected.mean())
    assert sorted(values(clean.impute_mean(incidents))) == pytest.approx(sorted(expected))


def test_minmax_equals_pandas(incidents):
    v = incidents.toPandas()["response_time"]
    expected = ((v - v.min()) / (v.max() - v.min())).dropna()
    scaled = clean.minmax_scale(incidents)
    got = [x for x in values(scaled, "response_time_normalized") if x is not None]
    assert sorted(got) == pytest.approx(sorted(expected))
    assert min(got) == 0 and max(got) == 1


def test_statistics_on_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    no_value = spark.createDataFrame([("a", None, None, None, None, None)], SCHEMA)
    constant = spark.createDataFrame([(i, None, None, None, None, 7.0) for i in "abc"], SCHEMA)
    one = constant.limit(1)
    assert clean.impute_mean(empty).count() == 0
    assert values(clean.impute_mean(no_value)) == [None]
    assert values(clean.minmax_scale(constant), "response_time_normalized") == [None] * 3
    for df in (empty, no_value, constant, one):
        assert clean.zscore_outliers(df).count() == 0


def test_zscore_outliers_equals_pandas(spark):
    rows = [(str(i), None, None, None, None, float(i % 10)) for i in range(200)]
    rows += [("far", None, None, None, None, 500.0), ("null", None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    v = df.toPandas()["response_time"]
    z = ((v - v.mean()) / v.std()).abs()
    assert clean.zscore_outliers(df).count() == int((z > 3).sum()) == 1


def test_drop_rules(incidents):
    pdf = incidents.toPandas()
    assert clean.drop_any_null(incidents).count() == len(pdf.dropna())
    assert clean.drop_null_key(incidents).count() == len(pdf.dropna(subset=["incident_id"]))


def test_below_leaves_nulls_out(incidents):
    assert sorted(values(clean.below(incidents))) == [-5.0, 120.0, 2400.0, 2401.0, 3599.0]


def test_validity_flag_equals_pandas(incidents):
    expected = incidents.toPandas()["severity"].str.lower().isin(scalar.VALID_SEVERITIES)
    flags = values(clean.validate_in(incidents), "valid_severity")
    assert sorted(flags) == sorted(expected.tolist())
    assert None not in flags


@pytest.mark.parametrize(
    "text", ["  Low ", "\tHIGH\n", " Medium ", "\x1ccritical\x1f", "two words", "", "   "]
)
def test_normalize_strips_like_python(spark, text):
    df = spark.createDataFrame([(text,)], "severity string")
    assert values(clean.normalize_column(df), "severity") == [text.lower().strip()]


def test_lower_trim_keeps_tabs(spark):
    df = spark.createDataFrame([(" \tLow ",)], "s string")
    assert df.select(scalar.lower_trim("s")).first()[0] == "\tlow"


def test_coerce_equals_pandas(spark):
    texts = ["12", " 3.5 ", "-1e3", "+.5", "7.", "abc", "", "12d", "1f", "0x10", "1,5", "--2", None]
    df = spark.createDataFrame([(t,) for t in texts], "response_time string")
    expected = pd.to_numeric(pd.Series(texts), errors="coerce")
    for text, mine, theirs in zip(texts, values(clean.coerce_numeric(df)), expected):
        if text == "0x10":
            continue
        assert (mine is None and math.isnan(theirs)) or mine == theirs, text


def test_narrow_types_never_wraps(spark):
    df = spark.createDataFrame([(9,), (40000,)], "zone_id int")
    narrowed = clean.narrow_types(df, {"zone_id": "smallint"})
    assert narrowed.schema["zone_id"].dataType.simpleString() == "smallint"
    assert values(narrowed, "zone_id") == [9, None]


def test_labels(spark):
    rows = [("critical", 100.0), ("critical", 9000.0), ("low", 2401.0), ("low", 2400.0), (None, 3000.0), (None, None)]
    df = spark.createDataFrame(rows, "severity string, seconds double")
    labelled = df.select(
        "severity", "seconds",
        scalar.is_anomaly("severity", "seconds").alias("anomaly"),
        scalar.anomaly_reason("severity", "seconds").alias("reason"),
        scalar.priority_label("severity").alias("priority"),
    ).collect()
    assert [r.anomaly for r in labelled] == [True, True, True, False, True, None]
    assert [r.reason for r in labelled] == [
        "CRITICAL SEVERITY", "CRITICAL SEVERITY", "SLOW RESPONSE >40min", None, "SLOW RESPONSE >40min", None,
    ]
    assert [r.priority for r in labelled] == ["Critical", "Critical"] + ["Standard"] * 4


def test_minutes_need_a_known_unit(spark):
    df = spark.createDataFrame([(90.0,)], "v double")
    assert df.select(scalar.minutes("v"), scalar.minutes("v", "min")).first() == (1.5, 90.0)
    with pytest.raises(KeyError):
        scalar.minutes("v", "h")


def test_iso_text_keeps_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-01-01 00:00:07.179575' AS t")
    assert df.select(scalar.iso_text("t")).first()[0] == "2024-01-01T00:00:07.179575"
    assert df.select(scalar.hour_key("t")).first()[0] == 2024010100
    assert rows_of(df.select(F.lit(1))) == [(1,)]


def test_nan_counts_as_missing(spark):
    from tocsin.operators import quality

    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0), ("c", 3.0), ("d", None)], "incident_id string, response_time double")
    filled = {r["incident_id"]: r["response_time"] for r in clean.impute_mean(df).collect()}
    assert filled == {"a": 2.0, "b": 1.0, "c": 3.0, "d": 2.0}
    scaled = {r["incident_id"]: r["response_time_normalized"] for r in clean.minmax_scale(df).collect()}
    assert scaled == {"a": None, "b": 0.0, "c": 1.0, "d": None}
    assert clean.zscore_outliers(df).count() == 0
    bad = {(r["check"], r["column_name"]): r["bad_rows"] for r in quality.report(df).collect()}
    assert bad["nulls", "response_time"] == 2 and bad["above_range", "response_time"] == 0 and bad["outliers", "response_time"] == 0
