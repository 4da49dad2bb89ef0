"""Sinks: idempotent per-batch file writers, console, CSV, text dumps."""

from racestream.sinks.writers import (
    fan_out, write_csv, write_lines, write_text_dump,
)

__all__ = ["fan_out", "write_csv", "write_lines", "write_text_dump"]
