"""Keeping only recent rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Days each topic is kept.
DAYS = {
    "bus_gps": 1, "air_quality": 90, "smart_meters": 365, "traffic_signals": 7, "dlq": 30,
    "incidents": 7, "ward_energy_summary": 30, "health_advisories": 7,
}


def apply_retention(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows not older than ``days`` before the newest one.

    The newest time is a scalar subquery (a single value), so the result does not depend on
    the clock and nothing is joined.
    """
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"interval {int(days)} days"))


def retained(df: DataFrame, topic: str, ts: str = "ts") -> DataFrame:
    return apply_retention(df, ts, DAYS[topic])


def retained_lake(lake: DataFrame, days: int) -> DataFrame:
    """Lake rows within ``days`` of its newest date; the filter is on the date folder."""
    newest = lake.agg(F.max("date")).scalar()
    return lake.where(F.col("date") >= F.date_format(F.date_sub(newest.cast("date"), days), "yyyy-MM-dd"))
