"""Event-time conversions independent of the session time zone.

Batch code keeps ``TIMESTAMP_NTZ`` (wall clock, as the driver tables store it).
Watermarks need ``TIMESTAMP``; the wall clock is then read as UTC, so windows
align to the epoch exactly as they do on the wall-clock values.
"""

from pyspark.sql import Column, functions as F


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def ntz_to_instant(c: Column) -> Column:
    """Wall-clock ``TIMESTAMP_NTZ`` read as UTC -> ``TIMESTAMP``."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def instant_to_ntz(c: Column) -> Column:
    """``TIMESTAMP`` -> its UTC wall clock as ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())
