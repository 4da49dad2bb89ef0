"""Telemetry jobs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from racestream.operators.neighbours import track_neighbours_stream
from racestream.operators.telemetry import decode_telemetry
from racestream.session import scoped_conf


QUALITY_METRICS = "telemetry_quality"


def neighbours_stream(messages: DataFrame, targets, idle_timeout: str | None = None, history: int = 0) -> DataFrame:
    """Kafka-layout stream -> neighbour rows (state per session and target).

    Each micro-batch reports messages read and dropped as undecodable under
    ``observedMetrics['telemetry_quality']``.
    """
    return track_neighbours_stream(decode_telemetry(messages, observe=QUALITY_METRICS), targets,
                                   idle_timeout=idle_timeout, history=history)


def start_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                   available_now: bool = True, processing_time: str = "15 seconds",
                   state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream to files, with a checkpoint for recovery.

    ``state_partitions`` sets the partitions of stateful operators for a new
    query (kept in the checkpoint afterwards); default: the session's
    ``spark.sql.shuffle.partitions``.
    """
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    with scoped_conf(df.sparkSession, {"spark.sql.shuffle.partitions": state_partitions}):
        return w.start()
