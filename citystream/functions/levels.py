"""Breakpoint tables: advisory levels, advisory texts, alert severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, as (strictly above, result); the last entry is the default.
ADVISORY_LEVELS = [(300, "HAZARDOUS"), (200, "VERY_UNHEALTHY"), (None, "UNHEALTHY")]
ADVISORY_MESSAGES = [
    (300, "Immediate evacuation recommended. All outdoor activity prohibited."),
    (200, "Health alert: Everyone should avoid prolonged outdoor exposure."),
    (None, "Sensitive groups should avoid outdoor activity. General public: limit exposure."),
]
SEVERITIES = [(400, "CRITICAL"), (None, "HAZARDOUS")]


def by_breakpoint(value: Column, table: list[tuple[int | None, str]]) -> Column:
    result = F.lit(table[-1][1])
    for bound, label in reversed(table[:-1]):
        result = F.when(value > bound, F.lit(label)).otherwise(result)
    return result


def advisory_level(aqi: Column) -> Column:
    return by_breakpoint(aqi, ADVISORY_LEVELS)


def advisory_message(aqi: Column) -> Column:
    return by_breakpoint(aqi, ADVISORY_MESSAGES)


def severity(aqi: Column) -> Column:
    """NaN is above no bound here, unlike in Spark's order."""
    return by_breakpoint(F.nullif(aqi, F.lit(float("nan"))), SEVERITIES)
