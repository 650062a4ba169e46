"""Lines that many documents share, kept in levelled sorted runs.

``LineRuns`` is a store of ``(line, n, total, known)`` rows: a 64-bit hash of the line's
key, the documents of the batch that hold it, those of this and all earlier batches, and
whether an earlier batch held it. Each batch is one sorted, bucketed run. Adding a batch
merge-joins its lines with the runs that are there: the largest total of a line is that
of all batches so far. ``fanout`` runs of a level are compacted into one of the next, so
a store of b batches has O(fanout * log b) runs, and every line is rewritten O(log b) times.

Runs are bucketed and sorted by line, so that joining them moves no rows. A line
appears once in a run, so no bucket is hot. Only counts and hashes are stored.

Defined results: a null or empty text is one empty line; the empty key never
counts (``min_chars`` is at least 1); each row of the table is a document, also
when ids repeat or are null; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.llm.common import ID, KEYS, MARK, ROW, TEXT, keyed, map_arrow, scan_tasks, stored, unused, with_keys
from tocsin.session import new_path

#: Fixed by the contract: what is stripped from both ends of a line.
BLANKS = b" \t\n\x0b\f\r"
RUN = "line long, n long, total long, known boolean"
FANOUT = 4
#: Scanning tasks whose lines make a batch, at most; lines of a bucket, and buckets.
BATCH_TASKS, BUCKET_LINES, BUCKETS = 32, 20_000_000, 50_000


def line_keys(text: bytes) -> list[bytes]:
    """One key per line: ends stripped, A-Z lower-cased."""
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def line_hash(key: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(key)
    return value - (1 << 64) if value >> 63 else value


class LineRuns:
    """A levelled store of line counts. One writer at a time.

    Runs are tables with a path under the shared folder; the list of runs is held
    by this object, at most ``fanout`` entries for each level.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "line")
            .write.bucketBy(self.buckets, "line")
            .sortBy("line")
            .option("path", new_path(self.spark, name))
            .saveAsTable(name)
        )
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def runs(self) -> DataFrame:
        """All rows of all runs."""
        frame = self.spark.createDataFrame([], RUN)
        for name in (n for level in self.levels for n in level):
            frame = frame.unionByName(self.spark.table(name))
        return frame

    def add(self, lines: DataFrame) -> str:
        """Add a batch, given as one row ``line`` for each document and distinct line.

        Lines are folded before they are dealt out. The batch's lines are joined with
        every run; a line's total is its count on top of the largest total found.
        """
        own = self._write(lines.groupBy("line").agg(F.count("*").alias("n")).select("line", "n", F.col("n").alias("total"), F.lit(False).alias("known")))
        held = [name for level in self.levels for name in level]
        if held:
            marked = self.spark.table(own).select("line", "n")
            for k, name in enumerate(held):
                marked = marked.join(self.spark.table(name).select("line", F.col("total").alias(f"t{k}")).hint("merge"), "line", "left")
            before = F.greatest(F.lit(0), *[F.coalesce(f"t{k}", F.lit(0)) for k in range(len(held))])
            run = self._write(marked.select("line", "n", (F.col("n") + before).alias("total"), (before > 0).alias("known")))
            self._drop([own])
            own = run
        self._place(own, 0)
        return own

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._place(self._write(self._folded(full)), level + 1)
            self._drop(full)

    def _folded(self, names: list[str]) -> DataFrame:
        # Spark 4.1 takes a union of bucketed tables for parted by line and doesn't fold it
        # whole; of another key it knows nothing.
        frame = None
        for name in names:
            run = self.spark.table(name).select(F.bitwise_not("line").alias("key"), "n", "total", "known")
            frame = run if frame is None else frame.unionByName(run)
        folded = frame.groupBy("key").agg(F.sum("n").alias("n"), F.max("total").alias("total"), F.min("known").alias("known"))
        return folded.select(F.bitwise_not("key").alias("line"), "n", "total", "known")

    def fresh(self, name: str) -> DataFrame:
        """Lines of a run that no earlier batch held."""
        return self.spark.table(name).filter(~F.col("known")).select("line")

    def frequent(self, min_docs: int) -> DataFrame:
        """Lines found in at least so many documents of all batches together."""
        return self.runs().filter(F.col("total") >= min_docs).select("line").distinct()

    def close(self) -> None:
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def distinct_lines(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys, and the hashes of the distinct keys of each document's lines."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [
                sorted({line_hash(k) for k in set(line_keys(t)) if long_enough(k, min_chars)})
                for t in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lines, pa.list_(pa.int64()))], [ID, MARK, "lines"]
            )

    return map_arrow(keyed(docs, id_col, text_col), make, f"{ID} long, {MARK} int, lines array<long>")


def frequent_lines(
    docs: DataFrame, min_docs: int, min_chars: int, batches: int | None = None, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Row keys and ``frequent``, the hashes of a document's lines that are to go.

    Hashes of all lines are written once, each batch to a folder of its own: the lines of
    some tasks, or a share of a task's, so that there are more batches than a level
    holds. They go through the store. Frequent lines come back to their documents by a join on the
    line, whose hot keys Spark splits, and are folded to one list per document, which
    is never longer than the document.
    """
    spark = docs.sparkSession
    hashed = distinct_lines(docs, min_chars, id_col, text_col)
    tasks, wanted = max(1, scan_tasks(hashed)), batches or FANOUT + 1
    each = max(1, min(BATCH_TASKS, tasks // wanted))
    shares = -(-wanted // tasks)
    batch = F.floor(F.spark_partition_id() / each) * shares + F.pmod(F.xxhash64(ID, MARK), F.lit(shares))
    path = new_path(spark, "lines")
    hashed.withColumn("batch", batch.cast("int")).write.partitionBy("batch").parquet(path)
    hashed = spark.read.schema(f"{ID} long, {MARK} int, lines array<long>, batch int").parquet(path)
    if buckets is None:
        held = hashed.agg(F.sum(F.size("lines")).alias("n")).first().n or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(BUCKETS, held // BUCKET_LINES))
    store = LineRuns(spark, buckets)
    # As many numbers as there are batches; one that got no rows has no folder.
    for n in sorted(r.batch for r in hashed.select("batch").distinct().collect()):
        store.add(hashed.filter(F.col("batch") == n).select(F.explode("lines").alias("line")))
    gone = stored(store.frequent(min_docs), "frequent")
    store.close()
    found = hashed.select(*KEYS, F.explode("lines").alias("line")).join(gone, "line", "left_semi")
    return found.groupBy(*KEYS).agg(F.collect_set("line").alias("frequent"))


def without(text: bytes, frequent: list[int] | None, min_chars: int) -> list[bytes]:
    """The lines that stay."""
    lines = text.split(b"\n")
    if not frequent:
        return lines
    gone = set(frequent)
    return [r for r, k in zip(lines, line_keys(text), strict=True) if not long_enough(k, min_chars) or line_hash(k) not in gone]


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Row keys, ``n_lines``, ``n_dropped`` and the kept text of every row."""
    min_chars = max(1, min_chars)
    found = frequent_lines(docs, min_docs, min_chars, batches, None, id_col, text_col)
    rows = keyed(docs, id_col, text_col).join(found, KEYS, "left").select(*KEYS, TEXT, "frequent")

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(2).to_pylist()
            kept = [without(t, f, min_chars) for t, f in zip(texts, part.column(3).to_pylist(), strict=True)]
            lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
            arrays = [
                pa.array(lines),
                pa.array(lines - np.array([len(k) for k in kept], np.int64)),
                pa.array([b"\n".join(k) for k in kept], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *arrays], [ID, MARK, "n_lines", "n_dropped", "kept"]
            )

    return map_arrow(rows, make, f"{ID} long, {MARK} int, n_lines long, n_dropped long, kept binary").withColumn(
        "kept", F.col("kept").cast("string")
    )


def clean(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns with frequent lines taken out of the text; a null text stays null."""
    min_chars = max(1, min_chars)
    found = frequent_lines(docs, min_docs, min_chars, id_col=id_col, text_col=text_col)
    rows = with_keys(docs, id_col, text_col).join(found, KEYS, "left")
    at = docs.columns.index(text_col)

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = part.columns
            texts = columns[at].cast(pa.binary()).to_pylist()
            kept = [t and b"\n".join(without(t, f, min_chars)) for t, f in zip(texts, columns[-1].to_pylist(), strict=True)]
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns[:-1], part.schema.names[:-1])

    return rows.select(f"{ROW}.*", F.col("frequent").alias(unused(docs, "frequent"))).mapInArrow(make, docs.schema)
