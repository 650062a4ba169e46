"""Data quality: a report frame, its verdict and a gate for jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tocsin.operators.clean import known


class QualityError(ValueError):
    """Raised by a hard gate; carries the failed checks."""


@dataclass(frozen=True)
class Rules:
    # Fixed value: the columns every incident table has.
    required: list[str] = field(
        default_factory=lambda: ["incident_id", "timestamp", "zone", "severity", "response_time"]
    )
    key: list[str] = field(default_factory=lambda: ["incident_id"])
    value: str = "response_time"
    lowest: float = 0
    highest: float = 7200
    z_limit: float = 3.0


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls and NaN per column as rows, counted for all columns in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(known(df, c).isNull()).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("nulls")) for c in columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def duplicate_count(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys equal each other. Copies of a
    key are counted before the shuffle, so a key with many copies is no hot spot."""
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def measures(df: DataFrame, rules: Rules = Rules()) -> dict[str, Column]:
    """What one pass over the rows tells: nulls, range breaks, and count, mean and
    deviation of the value. Aggregates that tasks fold, so they can be taken on the way
    to a write (``DataFrame.observe``)."""
    out = {"rows": F.count(F.lit(1))}
    for i, c in enumerate(rules.required):
        if c in df.columns:
            out[f"nulls_{i}"] = F.count_if(known(df, c).isNull())
    if rules.value in df.columns:
        value = known(df, rules.value)
        out |= {"below": F.count_if(value < rules.lowest), "above": F.count_if(value > rules.highest)}
        out |= {"mean": F.avg(value), "std": F.stddev_samp(value)}
    return out


def report(df: DataFrame, rules: Rules = Rules(), measured: dict | None = None) -> DataFrame:
    """One row per check: ``check, column_name, bad_rows, passed``.

    Three scans: the required columns once for nulls, ranges and moments, the value
    column once against these, and the key once for duplicates. With what ``measures``
    gave on the way to a write, the first is saved.
    """
    aggregates = measures(df, rules)
    if measured is None:
        first = df.agg(F.struct(*[a.alias(name) for name, a in aggregates.items()])).scalar()
        found = {name: first.getField(name) for name in aggregates}
    else:
        kinds = {"mean": "double", "std": "double"}
        found = {name: F.lit(measured[name]).cast(kinds.get(name, "bigint")) for name in aggregates}
    checks: dict[tuple[str, str], Column] = {("column_present", c): F.lit(0 if c in df.columns else 1) for c in rules.required}
    checks |= {("nulls", c): found[f"nulls_{i}"] for i, c in enumerate(rules.required) if c in df.columns}
    outliers = F.lit(None)
    if rules.value in df.columns:
        checks |= {("below_range", rules.value): found["below"], ("above_range", rules.value): found["above"]}
        z = F.try_divide(known(df, rules.value) - found["mean"], found["std"])
        outliers = F.count_if(F.abs(z) > rules.z_limit)
        checks[("outliers", rules.value)] = F.col("_outliers")
    if all(k in df.columns for k in rules.key):
        checks[("duplicates", ",".join(rules.key))] = duplicate_count(df, rules.key).scalar()
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(name).alias("column_name"),
            bad.cast("bigint").alias("bad_rows"),
            (bad == 0).alias("passed"),
        )
        for (check, name), bad in checks.items()
    ]
    return df.agg(outliers.alias("_outliers")).select(F.inline(F.array(*rows)))


def measured_write(df: DataFrame, rules: Rules, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict | None]:
    """Write ``df`` and take its measures on the way: the stored table and the measures.
    None if nothing was measured, as of an empty frame; ``report`` then reads."""
    seen = Observation()
    stored = write(df.observe(seen, *[a.alias(name) for name, a in measures(df, rules).items()]))
    if stored.isEmpty():
        return stored, None
    return stored, seen.get


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("issues")
    )


def gate(df: DataFrame, rules: Rules = Rules(), on_fail: str = "raise", measured: dict | None = None) -> bool:
    """Run the checks now. ``on_fail="raise"`` stops the job, ``"report"`` only tells.

    Only failed checks reach the driver, a handful of rows whatever the table size.
    ``measured`` is what ``measures`` gave while ``df`` was written.
    """
    if on_fail not in ("raise", "report"):
        raise ValueError(f"on_fail must be 'raise' or 'report', not {on_fail!r}")
    failed = report(df, rules, measured).filter(~F.col("passed")).collect()
    if failed and on_fail == "raise":
        issues = ", ".join(f"{r['check']}({r['column_name']}): {r['bad_rows']}" for r in failed)
        raise QualityError(f"quality checks failed: {issues}")
    return not failed


def profile(df: DataFrame) -> DataFrame:
    """Position, name, type, nullability, rows and nulls per column, in one pass."""
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(known(df, f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)],
    )
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.lit(f.nullable).alias("nullable"),
            F.col("rows").alias("total_rows"),
            F.col(f"n{i}").alias("nulls"),
        )
        for i, f in enumerate(df.schema)
    ]
    return measured.select(F.inline(F.array(*rows)))
