import pytest

from helpers import SCHEMA, rows_of
from tocsin.operators import quality


def found(df, rules=quality.Rules()):
    return {(r["check"], r["column_name"]): r["bad_rows"] for r in quality.report(df, rules).collect()}


def test_report_equals_pandas(incidents):
    pdf = incidents.toPandas()
    v = pdf["response_time"]
    z = ((v - v.mean()) / v.std()).abs()
    got = found(incidents)
    for c in quality.Rules().required:
        assert got[("nulls", c)] == int(pdf[c].isnull().sum())
        assert got[("column_present", c)] == 0
    assert got[("below_range", "response_time")] == int((v < 0).sum())
    assert got[("above_range", "response_time")] == int((v > 7200).sum())
    assert got[("outliers", "response_time")] == int((z > 3).sum())
    assert got[("duplicates", "incident_id")] == int(pdf.duplicated(subset=["incident_id"]).sum())


def test_missing_columns_are_reported_not_raised(incidents):
    got = found(incidents.drop("response_time", "zone"))
    assert got[("column_present", "response_time")] == got[("column_present", "zone")] == 1
    assert ("nulls", "zone") not in got and ("outliers", "response_time") not in got


def test_duplicate_null_keys_count(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("a",)], "incident_id string")
    assert quality.duplicate_count(df, ["incident_id"]).first()[0] == 2


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert set(found(empty).values()) == {0}
    one = spark.createDataFrame([("a", None, None, None, None, 5.0)], SCHEMA)
    assert found(one)[("outliers", "response_time")] == 0


def test_verdict(spark, incidents):
    assert quality.verdict(quality.report(incidents)).first() == (False, 7)
    from datetime import datetime

    good = spark.createDataFrame(
        [(str(i), datetime(2024, 1, 1), "Fire", "low", "East", 10.0 + i) for i in range(5)], SCHEMA
    )
    assert quality.verdict(quality.report(good)).first() == (True, 0)
    assert quality.gate(good)


def test_gate_raises_or_reports(incidents):
    with pytest.raises(quality.QualityError, match=r"duplicates\(incident_id\): 1"):
        quality.gate(incidents)
    assert quality.gate(incidents, on_fail="report") is False
    with pytest.raises(ValueError):
        quality.gate(incidents, on_fail="ignore")


def test_profile_and_null_counts(incidents):
    profile = {r["column_name"]: r for r in quality.profile(incidents).collect()}
    assert profile["response_time"]["nulls"] == 1 and profile["response_time"]["total_rows"] == 8
    assert profile["timestamp"]["column_type"] == "timestamp"
    assert [r["position"] for r in sorted(profile.values(), key=lambda r: r["position"])] == list(range(6))
    assert dict(rows_of(quality.null_counts(incidents)))["zone"] == 1
