"""Windowed counts that need not be settled from all batches ever written, rows that
came too late for them, and the state store for streams that run for long.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tocsin import schemas
from tocsin.operators.tables import latest_per_key
from tocsin.sources import files
from tocsin.streaming import run
from tocsin.streaming.alerts import WATERMARK, WINDOW

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_FOLDS = schemas.struct("fold bigint, through bigint, closed_before timestamp")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks and
    not in their heap, and checkpoint only what a batch changed."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    for name, value in _ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class SettledWindows:
    """The output of an update-mode stream of windowed counts, settled fold by fold.

    ``run.start`` writes each batch to a folder under ``out``. ``settle`` takes the
    finished ones: a window that the watermark has passed is final and is written once;
    the others are carried to the next fold. So a fold costs its batches and the windows
    still open, and readers see the settled rows, one row for each open window, and the
    batches since. Folded batches are deleted.

    After a batch the watermark is at least the start of the latest window seen, less
    the delay, and later batches drop rows of windows that end before it. Such windows
    are final whatever is still to come.
    """

    def __init__(self, spark: SparkSession, out: str, schema: T.StructType, keys: list[str], delay: str = WATERMARK, length: str = WINDOW):
        self.spark, self.schema, self.keys = spark, schema, keys
        self._out, self._store = out, f"{out}-settled"
        self._delay, self._length = _span(delay), _span(length)

    def settle(self, ended: bool = False) -> int:
        """Fold the finished batches; returns the last one folded, -1 for none. The newest
        batch may still be in the writing, unless the stream has ``ended``."""
        last = self._last()
        done, fold = (last["through"], last["fold"] + 1) if last else (-1, 0)
        batches = self._since(done)
        newest = batches.agg(F.max("batch_id")).first()[0]
        finished = done if newest is None else newest if ended else newest - 1
        if finished <= done:
            return done
        rows = self._open(last).unionByName(batches.filter(F.col("batch_id") <= finished))
        seen = rows.agg(F.max("window_start")).first()[0]
        bound = max([t for t in (last and last["closed_before"], seen and seen - self._delay) if t], default=None)
        end = F.col("window_start") + F.lit(self._length)
        closed = F.lit(False) if bound is None else F.coalesce(end <= F.lit(bound), F.lit(False))
        settled = latest_per_key(rows, self.keys, ["batch_id"]).withColumn("closed", closed)
        settled.write.mode("overwrite").partitionBy("closed").parquet(self._folder(fold))
        record = self.spark.createDataFrame([(fold, finished, bound)], _FOLDS)
        record.coalesce(1).write.mode("append").parquet(f"{self._store}/folds")
        for batch in range(done + 1, finished + 1):
            self._delete(f"{self._out}/batch_id={batch}")
        if last:
            self._delete(f"{self._folder(last['fold'])}/closed=false")
        return finished

    def read(self) -> DataFrame:
        """One row for each group: settled ones as they are, open ones by their last batch."""
        last = self._last()
        newer = self._open(last).unionByName(self._since(last["through"] if last else -1))
        return self.closed().unionByName(latest_per_key(newer, self.keys, ["batch_id"]).drop("batch_id"))

    def closed(self) -> DataFrame:
        """Only the windows that are final."""
        last = self._last()
        folders = [f"{self._folder(n)}/closed=true" for n in range(last["fold"] + 1)] if last else []
        return self._read([f for f in folders if files.exists(self.spark, f)]).drop("batch_id")

    # -- inside ----------------------------------------------------------

    def _last(self) -> Row | None:
        if not files.exists(self.spark, f"{self._store}/folds"):
            return None
        return self.spark.read.schema(_FOLDS).parquet(f"{self._store}/folds").orderBy(F.desc("fold")).first()

    def _folder(self, fold: int) -> str:
        return f"{self._store}/rows/fold={fold}"

    def _since(self, done: int) -> DataFrame:
        return run.written(self.spark, self._out, self.schema).filter(F.col("batch_id") > done)

    def _open(self, last: Row | None) -> DataFrame:
        folder = f"{self._folder(last['fold'])}/closed=false" if last else None
        return self._read([folder] if folder and files.exists(self.spark, folder) else [])

    def _read(self, folders: list[str]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(stored).parquet(*folders) if folders else self.spark.createDataFrame([], stored)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _span(text: str) -> timedelta:
    number, unit = text.split()
    return timedelta(**{unit.rstrip("s") + "s": float(number)})


def start_late(
    alerts: DataFrame, out: str, checkpoint: str, delay: str = WATERMARK, length: str = WINDOW,
    trigger: str = run.AVAILABLE_NOW, name: str | None = None,
) -> StreamingQuery:
    """Write the rows that windowed counts of the same stream drop: those whose window
    ends no later than the watermark of their batch, the latest event time of all batches
    before less ``delay``. Read them with ``late_rows``.

    The stream's clock is a row per batch with the latest time so far, so a batch that is
    repeated after a failure finds the clock it had.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = _clock(spark, out, batch_id)
        watermark = clock and clock - _span(delay)
        if clock is None:
            # Nothing is late before there is a watermark.
            late, latest = batch.limit(0), batch.agg(F.max("event_time")).first()[0]
        else:
            late = batch.filter(_window_end(length) <= F.lit(watermark))
            latest = max(filter(None, [clock, batch.agg(F.max("event_time")).first()[0]]))
        late.withColumn("watermark", F.lit(watermark).cast("timestamp")).write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        row = spark.createDataFrame([(latest,)], "latest timestamp").coalesce(1)
        row.write.mode("overwrite").parquet(f"{out}/clock/batch_id={batch_id}")

    return run._launch(alerts.writeStream.foreachBatch(write_batch), "append", checkpoint, trigger, name)


def _clock(spark: SparkSession, out: str, batch_id: int) -> datetime | None:
    folder = f"{out}/clock/batch_id={batch_id - 1}"
    if not batch_id or not files.exists(spark, folder):
        return None
    return spark.read.schema("latest timestamp").parquet(folder).first()["latest"]


def _window_end(length: str) -> Column:
    """End of the tumbling window of ``event_time``, as the windowed counts have it."""
    step, at = F.lit(_span(length) // timedelta(microseconds=1)), F.unix_micros("event_time")
    return F.timestamp_micros(at - F.pmod(at, step) + step)


def late_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Rows behind the watermark of their batch, with that watermark and ``batch_id``."""
    return run.written(spark, f"{out}/late", T.StructType([*schema.fields, T.StructField("watermark", T.TimestampType())]))
