"""Jobs: chains of operators that write their results. Paths come from the caller.

A job hands one stage to the next through a written table, so a lost executor
repeats a stage and not the chain. Running a job again with the same run id
gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.operators import clean as ops
from tocsin.operators import quality, reports, star
from tocsin.operators.snapshots import SnapshotTable
from tocsin.sources import files


def cleaned(df: DataFrame, column: str = "response_time", key: str = "incident_id") -> DataFrame:
    """Impute the mean, drop rows without a key, scale and flag.

    The mean is over all rows, also those dropped afterwards; the bounds are over
    the kept rows with their imputed values. Both come from one statistics pass:
    an imputed value is the mean, so it is enough to know whether a kept row
    lacks its value. NaN counts as missing.
    """
    value, kept = ops.known(df, column), F.col(key).isNotNull()
    measured = df.agg(
        F.avg(value).alias("mean"),
        F.min(F.when(kept, value)).alias("low"),
        F.max(F.when(kept, value)).alias("high"),
        F.bool_or(kept & value.isNull()).alias("imputed"),
    )
    imputed = F.when(F.col("imputed"), F.col("mean"))
    stats = measured.select(
        F.struct("mean", F.least("low", imputed).alias("low"), F.greatest("high", imputed).alias("high"))
    ).scalar()
    # As a column, so that the plan holds the subquery once and not per use.
    rows = ops.drop_null_key(df, key).withColumn("_stats", stats)
    filled = rows.withColumn(column, F.coalesce(value, F.col("_stats.mean")))
    scaled = ops.scaled(F.col(column), F.col("_stats.low"), F.col("_stats.high"))
    return ops.validate_in(filled.withColumn(f"{column}_normalized", scaled).drop("_stats"))


def clean(df: DataFrame, out: str) -> DataFrame:
    """Cleaned incidents as CSV; returns the stored table."""
    result = cleaned(df)
    files.write_csv(result, out)
    return files.read_csv(df.sparkSession, out, result.schema)


def etl(df: DataFrame, out: str, now: Column | None = None) -> DataFrame:
    """Transform, then load: number check, complete rows only, normal severity, load time."""
    result = ops.normalize_column(ops.drop_any_null(ops.coerce_numeric(df)))
    stamped = result.withColumn("processed_at", F.current_timestamp() if now is None else now)
    return files.replace_table(stamped, out)


def elt(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Load raw, then transform in SQL."""
    loaded = files.replace_table(df, raw)
    result = df.sparkSession.sql(
        """
        SELECT *, lower(trim(severity)) AS clean_severity
        FROM {raw_incidents}
        WHERE response_time IS NOT NULL
        """,
        raw_incidents=loaded,
    )
    return files.replace_table(result, out)


def compare(etl_table: DataFrame, elt_table: DataFrame) -> DataFrame:
    """Rows and mean of both results side by side, and whether they agree."""
    both = reports.side_by_side(etl=etl_table, elt=elt_table)
    mean = F.round("avg_response", 6)
    same = (F.min("total_rows") == F.max("total_rows")) & F.min(mean).eqNullSafe(F.max(mean))
    return both.withColumn("equivalent", both.agg(same).scalar())


def nightly(
    df: DataFrame, root: str, run_id: str, rules: quality.Rules = quality.Rules()
) -> SnapshotTable:
    """Extract, gate, transform, load, append a version. The gate stops the job
    before anything but the extract is written; most of it is measured on that write."""
    spark = df.sparkSession
    extract, measured = quality.measured_write(df, rules, lambda rows: files.replace_table(rows, f"{root}/extract/run_id={run_id}"))
    quality.gate(extract, rules, on_fail="raise", measured=measured)
    result = ops.lower_column(ops.drop_any_null(extract))
    transformed = files.replace_table(result, f"{root}/transformed/run_id={run_id}")
    files.append_run(transformed, f"{root}/incidents", run_id)
    table = SnapshotTable(spark, f"{root}/lake")
    table.append(transformed, run_id=run_id)
    return table


def nightly_loaded(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows the nightly runs have loaded, with their run id."""
    return files.read_runs(spark, f"{root}/incidents", schema)


def capstone(
    df: DataFrame, root: str, run_id: str, rules: quality.Rules = quality.Rules()
) -> tuple[DataFrame, bool]:
    """Process, store a version, check without stopping, refresh the dashboard.

    Returns the stored dashboard and whether the checks passed.
    """
    spark = df.sparkSession
    result = ops.lower_column(ops.drop_null_key(df))
    prepared, measured = quality.measured_write(result, rules, lambda rows: files.replace_table(rows, f"{root}/prepared/run_id={run_id}"))
    table = SnapshotTable(spark, f"{root}/lake")
    table.append(prepared, run_id=run_id)
    passed = quality.gate(prepared, rules, on_fail="report", measured=measured)
    summary = reports.dashboard(table.read())
    files.write_csv(summary, f"{root}/dashboard")
    return files.read_csv(spark, f"{root}/dashboard", summary.schema), passed


def load_star(
    facts: DataFrame,
    root: str,
    places: DataFrame,
    units: DataFrame,
    crews: DataFrame | None = None,
    on: tuple[str, str] | None = None,
    key: str = "incident_id",
    ts: str = "timestamp",
    seconds: str = "response_time",
    severity: str = "severity",
    outcome: str | None = None,
) -> dict[str, DataFrame]:
    """Write the dimensions, then the fact table with their ids; returns the tables.

    Everything is built anew; ``StarStore`` adds to a star that is there. The arguments
    are those of ``star.with_ids``.
    """

    location, unit, grade, hours = files.replace_tables(
        {
            f"{root}/dim_location": star.dim_location(places),
            f"{root}/dim_unit": star.dim_unit(units),
            f"{root}/dim_severity": star.dim_severity(facts.select(F.col(severity).alias("severity"))),
            f"{root}/dim_time": star.dim_time(facts, ts),
        }
    ).values()
    dims = {"dim_time": hours, "dim_location": location, "dim_unit": unit, "dim_severity": grade}
    ready = star.with_ids(facts, dims, places, units, crews, on, severity)
    fact = files.replace_table(star.fact(ready, key, ts, seconds, outcome), f"{root}/fact_incidents")
    return {"fact_incidents": fact, **dims}
