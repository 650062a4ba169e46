"""Starting streams. Every query has a checkpoint, and every micro-batch writes to
a folder of its own that a repeated batch replaces, so results are exact after a
restart or a lost executor.
"""

from __future__ import annotations

import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tocsin import schemas
from tocsin.operators import reports, tables
from tocsin.operators.keyed_store import KeyedTable
from tocsin.operators.layout import cached
from tocsin.operators.tables import latest_per_key
from tocsin.session import together
from tocsin.sources import files
from tocsin.streaming import alerts as frames

AVAILABLE_NOW = "available now"


def _launch(
    writer: DataStreamWriter, mode: str, checkpoint: str, trigger: str, name: str | None
) -> StreamingQuery:
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    when = {"availableNow": True} if trigger == AVAILABLE_NOW else {"processingTime": trigger}
    return writer.trigger(**when).start()


def start(
    frame: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "update",
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch of ``frame`` as Parquet under ``out``.

    Update mode may write a group once per batch it changed in: read the result
    with ``latest``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _launch(frame.writeStream.foreachBatch(write_batch), mode, checkpoint, trigger, name)


def start_console(
    frame: DataFrame,
    checkpoint: str,
    mode: str = "update",
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
    rows: int = 20,
) -> StreamingQuery:
    """Show the first rows of each micro-batch, for watching a stream by hand."""
    shown = frame.writeStream.format("console").options(truncate="false", numRows=str(rows))
    return _launch(shown, mode, checkpoint, trigger, name)


def start_all(
    alerts: DataFrame, out: str, checkpoint: str, trigger: str | None = None
) -> list[StreamingQuery]:
    """The three standing queries, each at its own interval unless ``trigger`` sets
    one for all. Wait for them with ``spark.streams.awaitAnyTermination()``."""
    plans = [
        ("zone_activity", frames.zone_counts(alerts), "update", "15 seconds"),
        ("anomaly_detector", reports.anomalies(alerts), "append", "10 seconds"),
        ("severity_breakdown", frames.severity_breakdown(alerts), "update", "20 seconds"),
    ]
    return [
        start(frame, f"{out}/{name}", f"{checkpoint}/{name}", mode, trigger or interval, name)
        for name, frame, mode, interval in plans
    ]


def written(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Everything a stream has written, with the ``batch_id`` it came in. No rows before
    the first batch."""
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not files.exists(spark, out):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(out)


def latest(spark: SparkSession, out: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest row per group of an update-mode output."""
    return latest_per_key(written(spark, out, schema), keys, ["batch_id"]).drop("batch_id")


def start_ingest(
    alerts: DataFrame,
    out: str,
    checkpoint: str,
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Take alerts in: store them, log them, dispatch the critical ones and count.

    A batch costs work in proportion to its own rows. Stored alerts are appended,
    already reduced to the last arrival per key within the batch; ``stored_alerts``
    settles keys that came in several batches. Messages of ``decode_traced`` that did
    not parse go to ``rejects`` with their text and to no other output; arrival is then
    ordered by ingest time, partition and offset.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        with cached(_traced(batch)) as whole:
            # Read and parsed once: this write fills the cache for the others.
            refused = whole.filter("rejected").select(_REJECT.names)
            refused.write.mode("overwrite").parquet(f"{out}/rejects/{part}")
            kept = whole.filter("NOT rejected")
            outputs = {
                "alerts": _store(kept),
                "dispatches": reports.dispatches(kept),
                "stats": reports.alert_stats(kept),
            }
            log = kept.drop("ingest_time", "event_time", *frames.TRACE).write.option("ignoreNullFields", "false")
            together(
                batch.sparkSession,
                partial(log.mode("overwrite").json, f"{out}/log/{part}"),
                *[
                    partial(df.write.mode("overwrite").parquet, f"{out}/{output}/{part}")
                    for output, df in outputs.items()
                ],
            )

    return _launch(alerts.writeStream.foreachBatch(write_batch), "append", checkpoint, trigger, name)


_ORDER = ["ingest_time", "partition", "offset"]
_ARRIVED = T.StructType(
    [*schemas.STORED_ALERT.fields, *schemas.struct("ingest_time timestamp, partition int, offset bigint")]
)
_REJECT = schemas.struct("ingest_time timestamp, partition int, offset bigint, raw string")


def _traced(batch: DataFrame) -> DataFrame:
    """Frames decoded without a trace have no rejects and no place."""
    if "rejected" in batch.columns:
        return batch
    return tables.add_missing(batch, schemas.struct("partition int, offset bigint, raw string")).withColumn(
        "rejected", F.lit(False)
    )


def rejected(spark: SparkSession, out: str) -> DataFrame:
    """Messages that did not parse, with their text, and the batch they came in."""
    return written(spark, f"{out}/rejects", _REJECT)


def _store(batch: DataFrame) -> DataFrame:
    return _settled(batch.select(_ARRIVED.names), _ORDER)


def _settled(rows: DataFrame, order: list[str]) -> DataFrame:
    """Last arrival per key. Rows without a key match nothing, so all are kept."""
    keyed = latest_per_key(rows.filter("incident_id IS NOT NULL"), ["incident_id"], order)
    return keyed.unionByName(rows.filter("incident_id IS NULL"))


#: Buckets of the folded table; a fold rewrites those that got rows.
FOLDED_BUCKETS = 256


def _arrivals(spark: SparkSession, out: str, buckets: int = FOLDED_BUCKETS) -> tuple[DataFrame, KeyedTable, int]:
    """The batches that are left to settle, the folded table and its last batch."""
    folded = KeyedTable(spark, f"{out}/folded", ["incident_id"], buckets)
    last = folded.last()
    done = int(last["run_id"]) if last else -1
    return written(spark, f"{out}/alerts", _ARRIVED).filter(F.col("batch_id") > done), folded, done


def stored_alerts(spark: SparkSession, out: str) -> DataFrame:
    """One row per alert key, the last arrival over all batches."""
    rows, folded, done = _arrivals(spark, out)
    if done >= 0:
        rows = folded.read().unionByName(rows)
    return _settled(rows, ["batch_id", *_ORDER]).select(schemas.STORED_ALERT.names)


def fold_alerts(spark: SparkSession, out: str, buckets: int = FOLDED_BUCKETS) -> int:
    """Settle finished batches into a keyed table, so that ``stored_alerts`` need only
    settle later ones. Only buckets with keys of those batches are rewritten. Returns
    the last batch folded, -1 for none.

    Call it now and then beside a running intake: it leaves out the newest batch,
    which may still be in the writing.
    """
    rows, folded, done = _arrivals(spark, out, buckets)
    newest = written(spark, f"{out}/alerts", _ARRIVED).agg(F.max("batch_id")).first()[0]
    finished = -1 if newest is None else newest - 1
    if finished <= done:
        return done
    folded.upsert(rows.filter(F.col("batch_id") <= finished), ["batch_id", *_ORDER], run_id=str(finished))
    return finished


def alert_totals(spark: SparkSession, out: str) -> DataFrame:
    """Running totals: the sum of the counts that each batch wrote."""
    counts = written(spark, f"{out}/stats", schemas.ALERT_COUNT)
    return counts.groupBy("dimension", "value").agg(F.sum("alerts").alias("alerts"))


def alert_total(spark: SparkSession, out: str) -> DataFrame:
    """All alerts taken in: every one has a severity, be it ``unknown``."""
    counts = written(spark, f"{out}/stats", schemas.ALERT_COUNT).filter("dimension = 'severity'")
    return counts.agg(F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"))


class _Totals(StreamingQueryListener):
    """What each query has read, dropped as late and run, added up over its batches."""

    def __init__(self) -> None:
        self.rows: dict[str, list[int]] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        total = self.rows.setdefault(str(progress.runId), [0, 0, 0])
        total[0] += 1
        total[1] += progress.numInputRows
        total[2] += sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)] = event.exception


_RUNS = schemas.struct("name string, batches bigint, input_rows bigint, dropped_rows bigint")


def run_all(alerts: DataFrame, out: str, checkpoint: str, trigger: str | None = None, seconds: float | None = None) -> DataFrame:
    """Run the three standing queries together until all end, or for so many seconds.

    They end jointly: if one fails, the others are stopped and its error is raised.
    Returns a row for each: batches, rows read and rows dropped as late.
    """
    spark, totals = alerts.sparkSession, _Totals()
    spark.streams.addListener(totals)
    queries: list[StreamingQuery] = []
    until = None if seconds is None else time.monotonic() + seconds
    try:
        queries += start_all(alerts, out, checkpoint, trigger)
        while any(q.isActive for q in queries) and (until is None or time.monotonic() < until):
            for query in queries:
                query.awaitTermination(1)
                if query.exception():
                    raise query.exception()
    finally:
        for query in queries:
            query.stop()
        # Events come later than the end they tell of.
        for _ in range(300):
            if all(str(q.runId) in totals.ended for q in queries):
                break
            time.sleep(0.1)
        spark.streams.removeListener(totals)
    rows = [(q.name, *totals.rows.get(str(q.runId), [0, 0, 0])) for q in queries]
    return spark.createDataFrame(rows, _RUNS)
