"""Event-time parsing. Bad input gives NULL, never an error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def strict_utc(text: Column) -> Column:
    """Whole seconds with a literal ``Z``; anything else is NULL."""
    return F.try_to_timestamp(text, F.lit(STRICT_UTC))


def iso(text: Column) -> Column:
    return text.try_cast("timestamp")


def iso_or(text: Column, fallback: Column) -> Column:
    """Event time, or the transport time of the record when the text does not parse."""
    return F.coalesce(iso(text), fallback)


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970; the precision at which alert rules compare times."""
    return F.unix_millis(ts.cast("timestamp"))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, STRICT_UTC)


def time_slice(ts: Column, length_ms: int) -> Column:
    """Number of the fixed-length slice of the time line that holds ``ts``."""
    return F.floor(epoch_ms(ts) / F.lit(length_ms))
