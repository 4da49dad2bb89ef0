"""Text building that prints null as ``null``, like Java string concatenation."""

from pyspark.sql import Column, functions as F


def text_or_null(c: Column) -> Column:
    """Java ``"" + x``: the value's text, or ``null`` for a null reference."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def java_concat(*parts) -> Column:
    """Concatenate literals (``str``) and columns, nulls printed as ``null``."""
    cols = [F.lit(p) if isinstance(p, str) else text_or_null(p) for p in parts]
    return F.concat(*cols)
