import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import rows_of
from tocsin import schemas
from tocsin.operators import reports
from tocsin.sources import messages
from tocsin.streaming import alerts, run

START = datetime(2026, 4, 17, 11, 0, 0)


def alert(i, seconds, zone="North", severity="critical", response=100.0, **more):
    body = {
        "incident_id": f"i{i}", "timestamp": (START + timedelta(seconds=seconds)).isoformat(),
        "incident_type": "Fire", "zone": zone, "severity": severity, "response_time": response,
        "unit_id": "UNIT-101", "hospital_id": "HOSP-A", "priority": "Critical",
    }
    return json.dumps({**body, **more})


def message_frame(spark, bodies, arrival=START):
    rows = [("Fire", None if b is None else b.encode(), arrival + timedelta(seconds=n)) for n, b in enumerate(bodies)]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def publish(spark, topic, bodies, arrival=START):
    message_frame(spark, bodies, arrival).coalesce(1).write.mode("append").parquet(topic)


def test_decode_tolerates_bad_messages(spark):
    df = message_frame(
        spark,
        [alert(1, 5), "not json", '{"incident_id": "x", "timestamp": "never", "new_field": 1}', None, "{}"],
    )
    got = alerts.decode(df).collect()
    assert [r["incident_id"] for r in got] == ["i1", None, "x", None, None]
    assert [r["event_time"] for r in got] == [START + timedelta(seconds=5), None, None, None, None]
    assert got[0]["ingest_time"] == START
    assert [bytes(r["value"]) if r["value"] else None for r in alerts.rejects(df).collect()] == [b"not json", None]


def test_decode_accepts_the_short_form(spark):
    body = json.dumps({"incident_id": "s", "timestamp": "2026-04-17T11:00:00", "incident_type": "Fire", "priority": "High"})
    row = alerts.decode(message_frame(spark, [body])).first()
    assert (row["incident_id"], row["zone"], row["severity"]) == ("s", None, None)


@pytest.fixture
def places(path):
    return path("topic"), path("out"), path("checkpoint")


def decoded_stream(spark, topic):
    return alerts.decode(messages.file_stream(spark, topic))


def test_zone_counts_over_two_batches(spark, places):
    topic, out, checkpoint = places
    for bodies in (
        [alert(1, 0), alert(2, 29, severity="low"), alert(3, 30), alert(4, 10, zone="East")],
        [alert(5, 20), "broken", alert(6, 61)],
    ):
        publish(spark, topic, bodies)
        frame = alerts.zone_counts(decoded_stream(spark, topic))
        run.start(frame, out, checkpoint, "update").awaitTermination()
    got = rows_of(run.latest(spark, out, frame.schema, ["window_start", "window_end", "zone"]))
    at = [START + timedelta(seconds=s) for s in (0, 30, 60, 90)]
    assert sorted(got) == sorted([
        (at[0], at[1], "East", 1, 1), (at[0], at[1], "North", 3, 2),
        (at[1], at[2], "North", 1, 1), (at[2], at[3], "North", 1, 1),
    ])


def test_late_alerts_are_dropped_and_counted(spark, places):
    topic, out, checkpoint = places
    publish(spark, topic, [alert(1, 0), alert(2, 600)])
    frame = alerts.zone_counts(decoded_stream(spark, topic))
    run.start(frame, out, checkpoint, "update").awaitTermination()
    publish(spark, topic, [alert(3, 1), alert(4, 545)])
    query = run.start(frame, out, checkpoint, "update")
    query.awaitTermination()
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    got = run.latest(spark, out, frame.schema, ["window_start", "window_end", "zone"])
    assert got.agg(F.sum("incident_count")).first()[0] == 3


def test_severity_breakdown_equals_batch(spark, places):
    topic, out, checkpoint = places
    publish(spark, topic, [alert(i, i, severity=["low", "high"][i % 2], response=60.0 * i) for i in range(40)])
    frame = alerts.severity_breakdown(decoded_stream(spark, topic))
    run.start(frame, out, checkpoint, "update").awaitTermination()
    got = rows_of(run.latest(spark, out, frame.schema, ["window_start", "severity"]))
    assert got == rows_of(alerts.severity_breakdown(alerts.decode(spark.read.parquet(topic))))


def test_anomalies_stream_equals_batch_and_restart_adds_nothing(spark, places):
    topic, out, checkpoint = places
    publish(spark, topic, [alert(1, 0), alert(2, 1, severity="low", response=2500.0), alert(3, 2, severity="low")])
    frame = reports.anomalies(decoded_stream(spark, topic))
    for _ in range(2):
        run.start(frame, out, checkpoint, "append").awaitTermination()
    got = run.written(spark, out, frame.schema).drop("batch_id")
    assert rows_of(got) == rows_of(reports.anomalies(alerts.decode(spark.read.parquet(topic))))
    assert got.count() == 2


def traced_stream(spark, topic):
    return alerts.decode_traced(messages.file_stream(spark, topic))


def test_equal_times_are_ordered_by_offset(spark, places):
    """Times are whole milliseconds, so only the offset tells which message came last."""
    _, out, checkpoint = places
    topic = f"{out}-topic"
    rows = [("k", bytes(json.dumps({"incident_id": "i1", "zone": zone, "timestamp": when}), "utf-8"), START, 0, at)
            for zone, when, at in (("First", "2026-09-01T00:00:00", 7), ("Last", "2026-01-01T00:00:00", 8))]
    shape = "key string, value binary, timestamp timestamp, partition int, offset bigint"
    spark.createDataFrame(rows, shape).write.parquet(topic)
    stream = spark.readStream.schema(shape).parquet(topic)
    run.start_ingest(alerts.decode_traced(stream), out, checkpoint).awaitTermination()
    assert rows_of(run.stored_alerts(spark, out), "zone") == [("Last",)]


def test_ingest_stores_logs_dispatches_and_counts(spark, places):
    topic, out, checkpoint = places
    later = START + timedelta(minutes=5)
    publish(spark, topic, [alert(1, 0, severity="low"), alert(2, 0, severity="low"), alert(1, 3, zone="East")])
    run.start_ingest(traced_stream(spark, topic), out, checkpoint).awaitTermination()
    publish(spark, topic, [alert(2, 9, zone="West", severity="high"), "broken", "broken"], later)
    run.start_ingest(traced_stream(spark, topic), out, checkpoint).awaitTermination()

    stored = run.stored_alerts(spark, out)
    assert stored.columns == schemas.STORED_ALERT.names
    assert rows_of(stored, "incident_id", "zone", "severity") == [
        ("i1", "East", "critical"), ("i2", "West", "high"),
    ]
    assert rows_of(run.rejected(spark, out), "raw", "batch_id") == [("broken", 1), ("broken", 1)]
    log = spark.read.json(f"{out}/log")
    assert log.count() == 4 and "priority" in log.columns
    assert rows_of(spark.read.parquet(f"{out}/dispatches"), "incident_id") == [("i1",)]
    totals = {(r["dimension"], r["value"]): r["alerts"] for r in run.alert_totals(spark, out).collect()}
    assert totals[("severity", "low")] == 2 and ("severity", "unknown") not in totals
    assert sum(n for (d, _), n in totals.items() if d == "zone") == 4


def test_folding_changes_no_stored_alert(spark, places):
    topic, out, checkpoint = places

    def take_in(*bodies):
        publish(spark, topic, bodies)
        run.start_ingest(traced_stream(spark, topic), out, checkpoint).awaitTermination()

    assert run.stored_alerts(spark, out).collect() == [] and run.fold_alerts(spark, out) == -1
    take_in(alert(1, 0, severity="low"), alert(2, 0), "broken")
    assert run.fold_alerts(spark, out) == -1
    take_in(alert(1, 5, severity="high"))
    assert run.fold_alerts(spark, out) == 0
    take_in(alert(2, 9, zone="West"), alert(3, 9), "broken")
    before = rows_of(run.stored_alerts(spark, out))
    assert run.fold_alerts(spark, out) == 1
    assert run.fold_alerts(spark, out) == 1
    assert rows_of(run.stored_alerts(spark, out)) == before
    assert rows_of(run.stored_alerts(spark, out), "incident_id", "severity", "zone") == [
        ("i1", "high", "North"), ("i2", "critical", "West"), ("i3", "critical", "North"),
    ]


def test_repeated_batch_replaces_its_output(spark, path):
    out = path("out")
    df = spark.range(3)
    for _ in range(2):
        df.write.mode("overwrite").parquet(f"{out}/batch_id=0")
    assert run.written(spark, out, df.schema).count() == 3


def test_three_named_queries(spark, places):
    topic, out, checkpoint = places
    publish(spark, topic, [alert(1, 0), alert(2, 31, severity="low", response=9000.0)])
    queries = run.start_all(decoded_stream(spark, topic), out, checkpoint, trigger=run.AVAILABLE_NOW)
    assert sorted(q.name for q in queries) == ["anomaly_detector", "severity_breakdown", "zone_activity"]
    for q in queries:
        q.awaitTermination()
    assert spark.read.parquet(f"{out}/anomaly_detector").count() == 2
    assert spark.read.parquet(f"{out}/zone_activity").agg(F.sum("incident_count")).first()[0] == 2


def test_interval_trigger(spark, places):
    topic, out, checkpoint = places
    publish(spark, topic, [alert(1, 0)])
    query = run.start(decoded_stream(spark, topic), out, checkpoint, "append", trigger="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 1


def test_console(spark, places):
    topic, _, checkpoint = places
    publish(spark, topic, [alert(1, 0)])
    query = run.start_console(decoded_stream(spark, topic), checkpoint, "append", name="watch")
    query.awaitTermination()
    assert "Console" in query.lastProgress["sink"]["description"]
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_broker_source_asks_for_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        messages.kafka_stream(spark, "localhost:9092", "alerts")


def test_readers_before_the_first_batch(spark, path):
    out = path("ingest")
    assert run.rejected(spark, out).count() == run.alert_totals(spark, out).count() == run.stored_alerts(spark, out).count() == 0
    assert run.fold_alerts(spark, out) == -1
