"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from citystream.sources import files

# Scratch paths made inside a ``removed_after``; each thread has its own, so a micro-batch's are not taken for the caller's.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def build(app: str = "citystream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every transformation here relies on.

    Shuffle width is left to the cluster's configuration plus adaptive coalescing.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive event timestamps are UTC, so the session has to read them that way."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    On one machine (a ``local[...]`` master) it may be unset; then a folder in the warehouse serves.
    On a cluster an unset folder is an error: a local default would be a different disk per executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``scratch`` and ``cut`` placed in the shared folder inside.

    For steps that end with a written result: its path is made before, and frames that read the steps' tables are
    of no use afterwards. Scopes nest; each removes what was made directly in it.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            files.remove(spark, path)


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once, so several consumers do not recompute it.

    Parquet with the frame's own columns; a lost executor costs nothing, since the table stays. ``path`` is a fresh one
    of ``scratch``, for a table that has to outlive the ``removed_after`` it is written in.
    """
    spark = df.sparkSession
    path = path or scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
