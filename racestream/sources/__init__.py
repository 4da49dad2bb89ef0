"""Sources: clicks and telemetry, static or streaming."""

from racestream.sources.clicks import clicks_from_events, read_clicks, read_events
from racestream.sources.telemetry import kafka_layout_from_events, read_kafka, read_kafka_files

__all__ = [
    "clicks_from_events", "read_clicks", "read_events",
    "kafka_layout_from_events", "read_kafka", "read_kafka_files",
]
