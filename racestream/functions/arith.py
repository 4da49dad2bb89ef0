"""Arithmetic with Java double semantics (no error on division by zero)."""

from pyspark.sql import Column, functions as F

# Fixed value: kilometres per hour to metres per second, as the gap job writes it.
KPH_TO_MPS = 0.278


def ieee_divide(num: Column, den: Column) -> Column:
    """``num / den`` in doubles, with IEEE results for a zero divisor.

    ANSI mode raises on division by zero and ``try_divide`` gives null; the
    gap job relies on Java's +Infinity, -Infinity and NaN instead.
    """
    n = num.cast("double")
    d = den.cast("double")
    inf = F.lit(float("inf"))
    return (F.when(d == 0,
                   F.when(n > 0, inf).when(n < 0, -inf).otherwise(F.lit(float("nan"))))
            .otherwise(n / d))


def seconds_at_speed(metres: Column, speed_kph: Column) -> Column:
    """Seconds to cover ``metres`` at ``speed_kph``, as a 32-bit float."""
    return ieee_divide(metres, F.lit(KPH_TO_MPS) * speed_kph.cast("double")).cast("float")
