"""Latest row per key: changelog compaction and last known positions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Types of which two values make one number that a hash aggregate can keep.
_WHOLE = {"tinyint", "smallint", "int", "bigint"}
_TIMES = {"timestamp", "timestamp_ntz"}
_LOWEST = -(1 << 62)    # stands for null


def _rank(df: DataFrame, order: Sequence[str]) -> Column | None:
    """``order`` as one number of fixed width, or None if its columns are not all whole numbers and times, or more than two."""
    kinds = dict(df.dtypes)
    if len(order) > 2 or any(kinds[c] not in _WHOLE | _TIMES for c in order):
        return None
    parts = [F.coalesce(F.unix_micros(F.col(c).cast("timestamp")) if kinds[c] in _TIMES else F.col(c).cast("bigint"), F.lit(_LOWEST))
             for c in order]
    if len(parts) == 1:
        return parts[0]
    return parts[0].cast("decimal(19,0)") * F.lit(Decimal(1 << 64)) + parts[1].cast("decimal(19,0)")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], unique: bool = False) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    An aggregate, not a window: each task reduces its rows before the shuffle, so a key that
    owns a large part of the input costs one row per task. With ``unique``, no two rows of a key have the same order
    (an offset among it, say); then a hash aggregate keeps the greatest order alone, as one number, and a semi-join with it
    picks the rows. Nothing is sorted, and rows do not move while the keys' orders are small enough to broadcast.
    """
    rank = _rank(df, order) if unique else None
    if rank is not None:
        top = df.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(F.max(rank).alias("_top"))
        same = rank == F.col("_top")
        for c in keys:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        return df.join(top, same, "left_semi")
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def compact(changes: DataFrame) -> DataFrame:
    """Envelope rows of a changelog topic to its current content; null values are deletions."""
    current = latest_by_key(changes.where(F.col("key").isNotNull()).select("key", "value", "partition", "offset"),
                            ["key"], ["partition", "offset"], unique=True)
    return current.where(F.col("value").isNotNull())
