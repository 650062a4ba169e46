"""A stored table with one row per key, changed at the cost of the change.

Rows lie in buckets of their key's hash. A merge reads and writes the buckets that its
batch has keys in; the others keep their files. Each merge writes to a folder of its
own and then a row to ``merges``; a bucket is the folder of the last merge that names
it. A merge that fails has no row: readers don't see it and the next one replaces what
it left. Old folders stay readable, also for queries that run, until ``vacuum``.

A row with a null in its key matches nothing and is always added. One writer at a time.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin import schemas
from tocsin.operators.tables import latest_per_key
from tocsin.session import stored_once
from tocsin.sources import files

_BUCKET = "key_bucket"
#: Rows without a whole key; every merge that has some adds a folder of them.
_NO_KEY = -1
_MERGES = schemas.struct(
    "merge bigint, run_id string, timestamp timestamp, buckets bigints, of_buckets bigint, table_schema string, "
    "inserted bigint, updated bigint, kept bigint"
)


class KeyedTable:
    """``buckets`` counts when the table is begun: about as many as its later size in
    files of a few hundred megabytes."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.key, self._buckets = spark, key, buckets
        self._data, self._log = f"{path}/data", f"{path}/merges"

    # -- reading ---------------------------------------------------------

    def merges(self) -> DataFrame:
        if not files.exists(self.spark, self._log):
            return self.spark.createDataFrame([], _MERGES)
        return self.spark.read.schema(_MERGES).parquet(self._log)

    def last(self) -> Row | None:
        return self.merges().orderBy(F.desc("merge")).first()

    def read(self) -> DataFrame | None:
        """The table; None before the first merge."""
        last = self.last()
        return self._read(last, self._places()).drop(_BUCKET) if last else None

    # -- writing ---------------------------------------------------------

    def upsert(self, batch: DataFrame, order: list[str], run_id: str | None = None) -> int:
        """Insert the batch's rows or replace those of equal keys; returns the merge's number.

        The last row of a key by ``order`` wins over the batch's others and over the
        stored one. ``order`` columns that the table lacks only serve the choice. A run
        id that was merged before is not merged again. Columns new to the table are
        added, null in older rows; columns the batch lacks are null in its rows.
        """
        last = self.last()
        if last and run_id is not None:
            done = self.merges().filter(F.col("run_id") == run_id).first()
            if done:
                return done["merge"]
        buckets = last["of_buckets"] if last else self._buckets
        number = last["merge"] + 1 if last else 0
        whole = F.lit(True)
        for k in self.key:
            whole = whole & F.col(k).isNotNull()
        known = T.StructType.fromJson(json.loads(last["table_schema"])) if last else T.StructType([])
        shape = T.StructType([*known.fields, *[f for f in batch.schema if f.name not in known.names and not (last and f.name in order)]])
        keyed = latest_per_key(batch.filter(whole), self.key, order).withColumn(_BUCKET, self._bucket(buckets))
        nameless = batch.filter(~whole).withColumn(_BUCKET, F.lit(_NO_KEY).cast("bigint"))
        # Read again below, for the rows; first for the buckets, at most as many as there are.
        incoming = stored_once(keyed.unionByName(nameless), "merge")
        touched = sorted(r[0] for r in incoming.select(_BUCKET).distinct().collect())
        new = _shaped(incoming, shape).withColumn("_stored", F.lit(0))
        old = self._read(last, self._places(), [b for b in touched if b != _NO_KEY]) if last else None
        both = new if old is None else new.unionByName(_shaped(old, shape).withColumn("_stored", F.lit(1)))
        # One aggregate settles a bucket: a stored row goes if the batch has its key.
        struct = F.struct((-F.col("_stored")).alias("_new"), *[F.col(c) for c in shape.names if c not in self.key])
        settled = both.filter(F.col(_BUCKET) != _NO_KEY).groupBy(_BUCKET, *self.key).agg(F.max(struct).alias("_row"), F.count("*").alias("_n"))
        rows = settled.select(
            _BUCKET, *[F.col(c) if c in self.key else F.col(f"_row.{c}").alias(c) for c in shape.names],
            F.when(F.col("_row._new") < 0, "kept").when(F.col("_n") > 1, "updated").otherwise("inserted").alias("_what"),
        )
        rows = rows.unionByName(new.filter(F.col(_BUCKET) == _NO_KEY).drop("_stored").withColumn("_what", F.lit("inserted")))
        found = {"inserted": 0, "updated": 0, "kept": 0}
        if touched:
            counts = Observation()
            out = rows.observe(counts, *[F.count_if(F.col("_what") == w).alias(w) for w in found]).select(_BUCKET, *shape.names)
            # Buckets are files of their own; a large one is split among tasks.
            out.hint("rebalance", F.col(_BUCKET)).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self._data}/merge={number}")
            found = counts.get
        record = (number, run_id, datetime.now(timezone.utc), touched, buckets, shape.json(), found["inserted"], found["updated"], found["kept"])
        self.spark.createDataFrame([record], _MERGES).coalesce(1).write.mode("append").parquet(self._log)
        return number

    def vacuum(self) -> int:
        """Delete folders that no bucket is in any more; returns how many. Only while no
        query reads the table as it was."""
        used = set(self._places())
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        system = hadoop(self._data).getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for row in self.merges().select("merge", "buckets").toLocalIterator():
            for bucket in row["buckets"]:
                path = hadoop(self._folder(row["merge"], bucket))
                if (row["merge"], bucket) not in used and system.exists(path):
                    gone += bool(system.delete(path, True))
        return gone

    # -- inside ----------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("bigint")

    def _folder(self, merge: int, bucket: int) -> str:
        return f"{self._data}/merge={merge}/{_BUCKET}={bucket}"

    def _places(self) -> list[tuple[int, int]]:
        """Merge and bucket of every folder in use: a row for each bucket, and for each
        merge that brought rows without a key."""
        each = self.merges().select("merge", F.explode("buckets").alias("bucket"))
        apart = F.when(F.col("bucket") == _NO_KEY, F.col("merge"))
        return [(r["merge"], r["bucket"]) for r in each.groupBy("bucket", apart.alias("apart")).agg(F.max("merge").alias("merge")).collect()]

    def _read(self, last: Row, places: list[tuple[int, int]], some: list[int] | None = None) -> DataFrame:
        known = T.StructType.fromJson(json.loads(last["table_schema"]))
        shape = T.StructType([*known.fields, T.StructField(_BUCKET, T.LongType())])
        folders: dict[int, list[str]] = {}
        for merge, bucket in places:
            if some is None or bucket in some:
                folders.setdefault(merge, []).append(self._folder(merge, bucket))
        out = self.spark.createDataFrame([], shape)
        for merge, paths in folders.items():
            # A folder's bucket stands in its path, which begins with that of its merge.
            out = out.unionByName(self.spark.read.schema(shape).option("basePath", f"{self._data}/merge={merge}").parquet(*paths))
        return out


def _shaped(df: DataFrame, shape: T.StructType) -> DataFrame:
    """The bucket and the columns of ``shape``; absent ones are null."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in shape]
    return df.select(_BUCKET, *columns)
