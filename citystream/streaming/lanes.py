"""Two independent readers of the signal stream: an unthrottled lane and a slow one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from citystream import schemas
from citystream.operators.decode import from_json_value
from citystream.operators.feed import LANES, signal_feed
from citystream.streaming.sinks import to_table

HIGH, STANDARD = LANES


def lane_feed(raw: DataFrame, lane: str) -> DataFrame:
    return signal_feed(from_json_value(raw, schemas.TRAFFIC_SIGNALS), lane).select("offset", "line")


def start_lane(raw: DataFrame, lane: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Each lane has its own checkpoint, so it keeps its own position in the stream.

    A lane is slowed at its source (``max_offsets`` / ``max_files``), never by sleeping in a task.
    """
    return to_table(lane_feed(raw, lane), path, checkpoint, trigger=trigger)


def backlog(query: StreamingQuery) -> dict[str, object]:
    """Position and speed of a lane from its last progress report."""
    progress = query.lastProgress
    if progress is None:
        return {"batch_id": None, "rows": 0, "rows_per_second": 0.0, "sources": []}
    return {
        "batch_id": progress["batchId"],
        "rows": progress["numInputRows"],
        "rows_per_second": progress["processedRowsPerSecond"],
        "sources": [{"end": s["endOffset"], "latest": s["latestOffset"]} for s in progress["sources"]],
    }


def lag(lane: str, query: StreamingQuery, total: int) -> list[tuple[str, int, int, int]]:
    """Per micro-batch of a lane, from its progress reports: lane, batch, rows read, and rows of ``total`` still behind it.

    Reports of empty triggers are left out; Spark keeps the last 100 (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    out, done = [], 0
    for progress in query.recentProgress:
        if rows := progress["numInputRows"]:
            done += rows
            out.append((lane, len(out), rows, total - done))
    return out
