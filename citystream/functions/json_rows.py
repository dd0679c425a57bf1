"""Row to JSON text, in the two null conventions the outgoing streams use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_json(*columns) -> Column:
    """Null fields are left out."""
    return F.to_json(F.struct(*columns))


def full_json(*columns) -> Column:
    """Null fields are written as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
