"""Column expressions (JVM-side, inside whole-stage codegen)."""

from racestream.functions.json import int32_or_null, json_number
from racestream.functions.arith import ieee_divide, seconds_at_speed
from racestream.functions.text import text_or_null
from racestream.functions.time import ntz_to_instant, instant_to_ntz

__all__ = [
    "int32_or_null", "json_number", "ieee_divide", "seconds_at_speed", "text_or_null",
    "ntz_to_instant", "instant_to_ntz",
]
