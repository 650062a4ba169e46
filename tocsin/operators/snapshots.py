"""Versioned tables on plain Parquet.

A table is a folder with three datasets: ``data``, in parts by the version that wrote
them and, for a table split by a key, by ranges of that key; ``parts``, a row for each
part that a version added or removed, with its least and greatest key; and ``history``,
one row per version. So

- an append writes the new rows only and adds their parts,
- an update rewrites only the parts in which a row changes; with a range of the key
  it does not look at parts outside that range,
- an overwrite starts over: later versions look no further back,
- a read lists the folders of its parts, those of its range if it has one.

Data is written before its parts, these before the history row. A version without one
does not exist for readers, and the next writer replaces what a failed one left behind.
One writer at a time.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin import schemas
from tocsin.operators import quality, tables
from tocsin.sources import files

_VERSION, _PIECE = "snapshot_version", "snapshot_piece"
_HISTORY = schemas.struct(
    "version bigint, timestamp timestamp, operation string, operation_metrics map, "
    "base bigint, table_schema string, run_id string"
)
_PARTS = schemas.struct("part_version bigint, piece bigint, added boolean, least string, greatest string, rows bigint")
Part = tuple[int, int]


class SchemaMismatch(ValueError):
    """The rows offered do not fit the table."""


class SnapshotTable:
    """``split_by`` names a column whose ranges become parts of their own: as many as
    ``pieces``, or as Spark finds large enough."""

    def __init__(self, spark: SparkSession, path: str, split_by: str | None = None, pieces: int | None = None):
        self.spark, self.split_by, self._pieces = spark, split_by, pieces
        self._data = f"{path}/data"
        self._part_log = f"{path}/parts"
        self._log = f"{path}/history"

    # -- reading ---------------------------------------------------------

    def history(self, n: int | None = None) -> DataFrame:
        """Versions, newest first."""
        newest = self._history_rows().orderBy(F.desc("version"))
        return newest if n is None else newest.limit(n)

    def latest_version(self) -> int:
        return self._entry(None)["version"]

    def last_run_id(self) -> str | None:
        """Run id of the newest version, None also when there is no version."""
        last = self._last()
        return last["run_id"] if last else None

    def read(self, version: int | None = None, between: tuple | None = None) -> DataFrame:
        """The newest version, or the table as it was at ``version``. ``between`` takes
        the rows with a key in that range, ends included; other parts are not listed."""
        entry = self._entry(version)
        if between is None:
            return self._rows(entry)
        return self._rows(entry, self._listed(entry, between)).filter(F.col(self._key()).between(*between))

    def parts(self, version: int | None = None) -> DataFrame:
        """The parts of a version with their rows and their least and greatest key."""
        return self._state(self._entry(version))

    def changes(self, before: int, after: int, columns: list[str] | None = None) -> DataFrame:
        """Rows that differ between two versions, with their number of copies in each.

        Parts that both versions have hold equal rows on both sides and are not read.
        """
        old, new = self._entry(before), self._entry(after)
        return tables.row_changes(*self._sides(old, new), columns)

    def change_feed(self, before: int, after: int, key: list[str]) -> DataFrame:
        """What happened to each key between two versions; see ``tables.change_feed``."""
        return tables.change_feed(*self._sides(self._entry(before), self._entry(after)), key)

    def describe(self, version: int | None = None) -> DataFrame:
        """Columns with type, nullability, rows and nulls."""
        return quality.profile(self.read(version))

    # -- writing ---------------------------------------------------------

    def overwrite(self, df: DataFrame, new_schema: bool = False, run_id: str | None = None) -> int:
        """Replace the content. The schema must stay, unless ``new_schema`` is set."""
        last = self._last()
        if done := self._done(run_id, last):
            return done["version"]
        if last and not new_schema:
            df = self._fit(df, last)
        return self._commit(df, last, "OVERWRITE", run_id=run_id)

    def append(self, df: DataFrame, run_id: str | None = None, evolve: bool = False) -> int:
        """Add rows. A run id that was committed before is not written again.

        With ``evolve`` columns new to the table are added, null in older rows, and types
        grow where ``tables.wider`` has one for both; a column that has none is an error.
        """
        last = self._last()
        if done := self._done(run_id, last):
            return done["version"]
        if last:
            df = self._fit(df, last, evolve)
        return self._commit(df, last, "APPEND", run_id=run_id)

    def update(self, *rules: tuple[str, dict[str, str]], run_id: str | None = None, between: tuple | None = None) -> int:
        """Apply ``(condition, {column: expression})`` rules in order.

        All rules go over the rows together and make one version; a rule sees what
        the rules before it did. Without any matching row there is no new version.
        ``between`` restricts the rules to rows with a key in that range.
        """
        last = self._entry(None)
        if done := self._done(run_id, last):
            return done["version"]
        listed = self._listed(last, between)
        before = self._parts(last, listed)
        # The first rule to match a row sees it unchanged, so a row changes exactly if
        # some condition holds on its old values. That test can reach the file scan.
        hit = reduce(or_, [F.expr(condition) for condition, _ in rules])
        within = F.lit(True) if between is None else F.col(self._key()).between(*between)
        # Parts only: as many as were written, not rows.
        touched = [tuple(row) for row in before.filter(hit & within).select(_VERSION, _PIECE).distinct().collect()]
        if not touched:
            return last["version"]
        # A part that is rewritten stays one part, so its rows need not be dealt out again.
        places = self.spark.createDataFrame([(v, p, n) for n, (v, p) in enumerate(touched)], f"{_VERSION} long, {_PIECE} long, _piece long")
        df = self._parts(last, touched).join(F.broadcast(places), [_VERSION, _PIECE]).drop(_VERSION, _PIECE)
        # Rows outside the range are rewritten as they are.
        df = df.withColumn("_within", F.coalesce(within, F.lit(False))).withColumn("_hit", hit & F.col("_within"))
        for condition, settings in rules:
            changed = {
                c: F.when(F.col("_within") & F.expr(condition), F.expr(value).cast(df.schema[c].dataType)).otherwise(F.col(c))
                for c, value in settings.items()
            }
            df = df.withColumns(changed)
        return self._commit(df.drop("_within"), last, "UPDATE", run_id, removed=touched)

    # -- inside ----------------------------------------------------------

    def _history_rows(self) -> DataFrame:
        return self.spark.read.schema(_HISTORY).parquet(self._log)

    def _last(self) -> Row | None:
        if not files.exists(self.spark, self._log):
            return None
        return self._history_rows().orderBy(F.desc("version")).first()

    def _entry(self, version: int | None) -> Row:
        if version is None:
            entry = self._last()
        else:
            entry = self._history_rows().filter(F.col("version") == version).first()
        if entry is None:
            raise ValueError("no such version" if version is not None else "the table is empty")
        return entry

    def _done(self, run_id: str | None, last: Row | None) -> Row | None:
        if run_id is None or last is None:
            return None
        if last["run_id"] == run_id:
            return last
        return self._history_rows().filter(F.col("run_id") == run_id).first()

    def _key(self) -> str:
        if self.split_by is None:
            raise ValueError("the table is not split by a key")
        return self.split_by

    def _rows(self, entry: Row, some: list[Part] | None = None) -> DataFrame:
        return self._parts(entry, some).drop(_VERSION, _PIECE)

    def _state(self, entry: Row) -> DataFrame:
        """Parts added since the last overwrite and not removed. Versions are numbered
        without gaps, so their folders are known."""
        folders = [f"{self._part_log}/of_version={v}" for v in range(entry["base"], entry["version"] + 1)]
        log = self.spark.read.schema(_PARTS).parquet(*folders)
        bounds = [F.max(c).alias(c) for c in ("least", "greatest", "rows")]
        held = log.groupBy("part_version", "piece").agg(F.bool_and("added").alias("added"), *bounds)
        return held.filter("added").drop("added")

    def _listed(self, entry: Row, between: tuple | None = None) -> list[Part]:
        """Places of a version's parts; those whose keys may lie in the range, if one is given."""
        state = self._state(entry).filter("rows > 0")
        if between is not None:
            kind = self._schema(entry)[self._key()].dataType
            low, high = between
            state = state.filter((F.col("least").cast(kind) <= high) & (F.col("greatest").cast(kind) >= low))
        return sorted((r["part_version"], r["piece"]) for r in state.select("part_version", "piece").collect())

    def _sides(self, old: Row, new: Row) -> list[DataFrame]:
        """The rows of two versions without the parts that both have."""
        listed = [self._listed(old), self._listed(new)]
        shared = set(listed[0]) & set(listed[1])
        return [self._rows(e, [p for p in some if p not in shared]) for e, some in zip((old, new), listed)]

    def _schema(self, entry: Row) -> T.StructType:
        return T.StructType.fromJson(json.loads(entry["table_schema"]))

    def _parts(self, entry: Row, some: list[Part] | None = None) -> DataFrame:
        """All or some parts of a version. Only their folders are listed."""
        stored = T.StructType([*self._schema(entry).fields, T.StructField(_VERSION, T.LongType()), T.StructField(_PIECE, T.LongType())])
        parts = self._listed(entry) if some is None else some
        if not parts:
            return self.spark.createDataFrame([], stored)
        folders = [f"{self._data}/{_VERSION}={version}/{_PIECE}={piece}" for version, piece in parts]
        return self.spark.read.schema(stored).option("basePath", self._data).parquet(*folders)

    def check(self, df: DataFrame) -> DataFrame:
        """What ``append`` with ``evolve`` would do with each column; see ``tables.schema_fit``."""
        fit = tables.schema_fit(self._schema(self._entry(None)), df.schema)
        return self.spark.createDataFrame(fit, "column_name string, table_type string, offered_type string, decision string")

    def _fit(self, df: DataFrame, last: Row, evolve: bool = False) -> DataFrame:
        """Check the columns against the table; absent ones are filled with nulls, and
        new ones stand last if the table may evolve."""
        schema = self._schema(last)
        for name, held, new, decision in tables.schema_fit(schema, df.schema):
            if decision == "add" and not evolve:
                raise SchemaMismatch(f"column {name} is not in the table")
            if decision == "refuse" or decision in ("cast", "widen") and not evolve:
                raise SchemaMismatch(f"column {name} is {held}, not {new}")
        return tables.fitted(df, schema)[0]

    def _commit(
        self, df: DataFrame, last: Row | None, operation: str, run_id: str | None, removed: list[Part] | None = None
    ) -> int:
        version = last["version"] + 1 if last else 0
        folder = f"{self._data}/{_VERSION}={version}"
        shape = T.StructType([f for f in df.schema if f.name not in ("_piece", "_hit")])
        ranged = self.split_by is not None and operation != "UPDATE"
        written = Observation()
        if ranged:
            out = df.repartitionByRange(*([self._pieces] if self._pieces else []), self.split_by)
            out = out.withColumn("_piece", F.spark_partition_id().cast("bigint"))
        else:
            changed = [F.count_if("_hit").alias("updated_rows")] if operation == "UPDATE" else []
            out = df.observe(written, F.count(F.lit(1)).alias("rows"), *changed).drop("_hit")
            out = out if operation == "UPDATE" else out.withColumn("_piece", F.lit(0).cast("bigint"))
        out.withColumnRenamed("_piece", _PIECE).write.mode("overwrite").partitionBy(_PIECE).parquet(folder)
        found = None if ranged else written.get
        rows = self._log_parts(version, folder, shape, found and found["rows"], removed or [])
        metrics = {name: str(value) for name, value in (found or {"rows": rows}).items()}
        row = (
            version,
            datetime.now(timezone.utc),
            operation,
            metrics,
            version if operation == "OVERWRITE" or last is None else last["base"],
            shape.json(),
            run_id,
        )
        self.spark.createDataFrame([row], _HISTORY).coalesce(1).write.mode("append").parquet(self._log)
        return version

    def _log_parts(self, version: int, folder: str, shape: T.StructType, rows: int | None, removed: list[Part]) -> int:
        """A row for each part that the version adds or removes; the rows it wrote."""
        if self.split_by is None and not removed:
            added = [(version, 0, True, None, None, rows)] if rows else []
        else:
            key = F.lit(None) if self.split_by is None else F.col(self.split_by)
            stored = self.spark.read.schema(T.StructType([*shape.fields, T.StructField(_PIECE, T.LongType())])).parquet(folder)
            # Only the key is read again.
            found = stored.groupBy(_PIECE).agg(F.min(key).cast("string"), F.max(key).cast("string"), F.count("*"))
            added = [(version, piece, True, least, greatest, n) for piece, least, greatest, n in found.collect()]
        gone = [(v, p, False, None, None, None) for v, p in removed]
        self.spark.createDataFrame([*added, *gone], _PARTS).coalesce(1).write.mode("overwrite").parquet(f"{self._part_log}/of_version={version}")
        return sum(part[5] for part in added)
