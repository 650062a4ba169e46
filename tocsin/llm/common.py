"""What the operators share: row keys, Arrow mapping, written tables, word hashes.

A document row is known by its id and a hash of its text, so that rows with a
null or repeated id keep apart. Rows equal in both get equal results. A null id
sorts before all others; a null text counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.session import new_path

ID, MARK, TEXT = "__id", "__mark", "__text"
KEYS = [ID, MARK]
NO_ID = -(2**63)


#: Rows handed to Python at a time. Texts are long and rows few, so Spark's default
#: would make batches of tens of megabytes, several of them in every task.
BATCH_ROWS, BATCH_BYTES = 1000, "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, if they have more, and ``BATCH_BYTES``."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def row_id(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def text_mark(text_col: str = "text") -> Column:
    """32 bits of the text's hash; they only part rows that share an id."""
    return F.xxhash64(F.col(text_col)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row keys and the UTF-8 bytes of the text, and nothing else."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        row_id(id_col).alias(ID),
        text_mark(text_col).alias(MARK),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(TEXT),
    )


ROW = "__row"


def with_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row keys, and all columns as the one struct ``__row``, whatever they are called;
    ``select("__row.*")`` brings them back."""
    bounded_batches(docs.sparkSession)
    return docs.select(row_id(id_col).alias(ID), text_mark(text_col).alias(MARK), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until the frame has no such column."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def map_arrow(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(make, schema)


def slices(batch: pa.RecordBatch, column: int = 2, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in turn, in slices of so many bytes of text; one row is never cut."""
    if not len(batch):
        return
    sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :][: len(batch) + 1].astype(np.int64))
    total = np.cumsum(sizes)
    start = 0
    while start < len(batch):
        base = total[start] - sizes[start]
        end = max(start + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to a new folder in the shared place and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts; one pass that carries one number per task."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)


def scan_tasks(df: DataFrame) -> int:
    """Partitions that a plan without shuffles has."""
    return df.rdd.getNumPartitions()


class WordHashes(dict):
    """64-bit hash of each word, kept until there are too many."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits, so that any of them can choose a bucket."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Polynomial (Rabin-Karp) hash modulo 2**64 of every run of ``width`` words.

    A run of an even length is its first half times a power plus its second half,
    so log2(width) passes make all of them.
    """
    if len(words) < width:
        return np.empty(0, np.uint64)
    done, have, step, reach = None, 0, words, 1
    while reach <= width:
        power = np.uint64(pow(int(BASE), reach, 1 << 64))
        if width & reach:
            if done is None:
                done, have = step, reach
            else:
                tail = step[have : have + len(words) - have - reach + 1]
                done, have = done[: len(tail)] * power + tail, have + reach
        if 2 * reach <= width:
            step = step[:-reach] * power + step[reach:]
        reach *= 2
    return mixed(done)
