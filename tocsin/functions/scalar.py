"""Column expressions. All are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted severities and the alert limits.
VALID_SEVERITIES = ["low", "medium", "high", "critical"]
CRITICAL = "critical"
VALID_LIMIT_SECONDS = 3600
SLOW_LIMIT_SECONDS = 2400
CRITICAL_REASON = "CRITICAL SEVERITY"
SLOW_REASON = "SLOW RESPONSE >40min"

# Whitespace as a text-cleaning user expects it: Unicode spaces plus the four
# ASCII separators, which the regex class leaves out.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# Plain decimal notation only: a cast alone would also take suffixes as in "12d".
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_UNIT_DIVISOR = {"s": 60.0, "min": 1.0}


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Lower case, all surrounding whitespace removed."""
    return F.regexp_replace(F.lower(column(c)), _EDGE_SPACE, "")


def lower_trim(c: Column | str) -> Column:
    """SQL ``LOWER(TRIM(c))``: removes spaces only, keeps tabs and line ends."""
    return F.lower(F.trim(column(c)))


def coerce_number(c: Column | str) -> Column:
    """Text to double; text that is no decimal number becomes null."""
    text = column(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_in(c: Column | str, allowed: list[str]) -> Column:
    """Case-insensitive membership; null is not a member."""
    return F.coalesce(F.lower(column(c)).isin(allowed), F.lit(False))


def minutes(c: Column | str, unit: str = "s") -> Column:
    """Durations differ in unit between sources, so the caller names it."""
    return column(c) / F.lit(_UNIT_DIVISOR[unit])


def iso_text(c: Column | str) -> Column:
    """Timestamp to ISO text in full precision, free of any time zone shift."""
    return F.replace(column(c).cast("string"), F.lit(" "), F.lit("T"))


def is_critical(c: Column | str, ignore_case: bool = False) -> Column:
    severity = column(c)
    return (F.lower(severity) if ignore_case else severity) == F.lit(CRITICAL)


def priority_label(severity: Column | str) -> Column:
    return F.when(is_critical(severity), "Critical").otherwise("Standard")


def is_anomaly(severity: Column | str, seconds: Column | str) -> Column:
    return is_critical(severity) | (column(seconds) > SLOW_LIMIT_SECONDS)


def anomaly_reason(severity: Column | str, seconds: Column | str) -> Column:
    """First match wins, so a critical and slow incident counts as critical."""
    return F.when(is_critical(severity), CRITICAL_REASON).when(
        column(seconds) > SLOW_LIMIT_SECONDS, SLOW_REASON
    )


def dispatch_text(unit: Column | str, zone: Column | str, hospital: Column | str) -> Column:
    """Dispatch order; a missing field shows as ``None``."""
    shown = [F.coalesce(column(c), F.lit("None")) for c in (unit, zone, hospital)]
    return F.format_string("CRITICAL ALERT - Dispatching %s to %s Zone -> %s", *shown)


def hour_key(ts: Column | str) -> Column:
    """Calendar hour as the integer yyyyMMddHH: a dimension id that needs no lookup."""
    t = column(ts)
    parts = F.year(t) * 1000000 + F.month(t) * 10000 + F.dayofmonth(t) * 100 + F.hour(t)
    return parts.cast("bigint")
