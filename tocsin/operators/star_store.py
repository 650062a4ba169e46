"""A star that grows by loads, with ids that last.

Every table is a folder with a part for each load that added to it; ``loads`` holds a
row per finished load, written last. A load adds the dimension rows that are new,
numbered from the greatest id on, and its facts; nothing stored before is written
again, so its cost follows the load and not the star. Parts of a load that failed have
no row: readers don't see them and the next load replaces them. One writer at a time.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin import schemas
from tocsin.operators import star
from tocsin.operators.tables import latest_per_key
from tocsin.session import together
from tocsin.sources import files

_LOAD = "load"
_COUNTS = T.MapType(T.StringType(), T.LongType())
_LOADS = T.StructType(
    [*schemas.struct("load bigint, run_id string, timestamp timestamp").fields, T.StructField("rows", _COUNTS), T.StructField("greatest", _COUNTS)]
)
_SHAPES = {
    "fact_incidents": schemas.FACT_INCIDENTS, "dim_time": schemas.DIM_TIME, "dim_location": schemas.DIM_LOCATION,
    "dim_unit": schemas.DIM_UNIT, "dim_severity": schemas.DIM_SEVERITY,
}
_NUMBERED = ("dim_location", "dim_unit", "dim_severity")


class StarStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._path = spark, path

    def loads(self) -> DataFrame:
        """Finished loads with the rows each added to each table and the greatest ids."""
        if not files.exists(self.spark, f"{self._path}/loads"):
            return self.spark.createDataFrame([], _LOADS)
        return self.spark.read.schema(_LOADS).parquet(f"{self._path}/loads")

    def tables(self, up_to: int | None = None) -> dict[str, DataFrame]:
        """The star as it is, or as it was after a load."""
        done = [r for r in self._done() if up_to is None or r["load"] <= up_to]
        return {name: self._read(name, done) for name in _SHAPES}

    def load(
        self,
        facts: DataFrame,
        run_id: str,
        places: DataFrame,
        units: DataFrame,
        crews: DataFrame | None = None,
        on: tuple[str, str] | None = None,
        key: str = "incident_id",
        ts: str = "timestamp",
        seconds: str = "response_time",
        severity: str = "severity",
        outcome: str | None = None,
        unique: bool = False,
    ) -> int:
        """Add facts and the dimension rows they need; returns the number of the load.

        A run id that was loaded before is not loaded again. With ``unique`` a key has
        one fact: of equal keys in the load the latest stays, and keys that are stored
        are passed over. Else facts are taken as they come. See ``star.with_ids`` for
        the other arguments.
        """
        done = self._done()
        for row in done:
            if row["run_id"] == run_id:
                return row["load"]
        number = done[-1]["load"] + 1 if done else 0
        greatest = done[-1]["greatest"] if done else {}
        sources = {
            "dim_location": star.natural(places, schemas.DIM_LOCATION),
            "dim_unit": star.natural(units, schemas.DIM_UNIT),
            "dim_severity": star.natural(facts.select(F.col(severity).alias("severity")), schemas.DIM_SEVERITY),
        }
        new = {name: star.added(df, self._read(name, done), _id(name), greatest.get(name, 0)) for name, df in sources.items()}
        hours = star.dim_time(facts, ts)
        new["dim_time"] = hours.join(self._read("dim_time", done), "time_id", "left_anti").select(schemas.DIM_TIME.names)
        names = list(new)
        counts = dict(zip(names, together(self.spark, *[partial(self._write, name, number, new[name]) for name in names])))
        rows = {name: count["rows"] for name, count in counts.items()}
        last = {name: max(greatest.get(name, 0), counts[name]["greatest"] or 0) for name in sources}
        held = [*done, Row(load=number, rows=rows)]
        dims = {name: self._read(name, held) for name in names}
        fact = star.fact(star.with_ids(facts, dims, places, units, crews, on, severity), key, ts, seconds, outcome)
        if unique:
            keyed = latest_per_key(fact.filter("incident_id IS NOT NULL"), ["incident_id"], ["time_id"])
            stored = self._read("fact_incidents", done).select("incident_id")
            fact = keyed.join(stored, "incident_id", "left_anti").unionByName(fact.filter("incident_id IS NULL"))
        rows["fact_incidents"] = self._write("fact_incidents", number, fact)["rows"]
        record = (number, run_id, datetime.now(timezone.utc), rows, last)
        self.spark.createDataFrame([record], _LOADS).coalesce(1).write.mode("append").parquet(f"{self._path}/loads")
        return number

    # -- inside ----------------------------------------------------------

    def _done(self) -> list[Row]:
        """One row for each load: as many as there were loads, whatever they held."""
        return self.loads().orderBy("load").collect()

    def _read(self, name: str, done: list[Row]) -> DataFrame:
        folders = [f"{self._path}/{name}/{_LOAD}={r['load']}" for r in done if r["rows"].get(name)]
        if not folders:
            return self.spark.createDataFrame([], _SHAPES[name])
        return self.spark.read.schema(_SHAPES[name]).parquet(*folders)

    def _write(self, name: str, number: int, df: DataFrame) -> dict:
        measured = Observation()
        last = F.max(_id(name)) if name in _NUMBERED else F.max(F.lit(None).cast("bigint"))
        out = df.observe(measured, F.count(F.lit(1)).alias("rows"), last.alias("greatest"))
        out.write.mode("overwrite").parquet(f"{self._path}/{name}/{_LOAD}={number}")
        return measured.get


def _id(dimension: str) -> str:
    return f"{dimension.removeprefix('dim_')}_id"
