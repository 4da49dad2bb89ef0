"""JSON field extraction with the click job's number rules."""

from pyspark.sql import Column, functions as F

# JSON as the standard has it: no single quotes, no NaN or Infinity
STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

INT_MIN, INT_MAX = -2147483648, 2147483647


def json_number(value: Column, key: str = "user.accountId") -> Column:
    """The number under one literal (dotted) top-level key, as a double, or null.

    ``key`` is one key of the top-level object, not a path. A JSON string,
    boolean, null, nested object or malformed text gives null.
    """
    return F.from_json(value, f"`{key}` DOUBLE", STRICT).getField(key)


def int32_or_null(d: Column) -> Column:
    """Truncate toward zero when inside the int32 range, else null."""
    return F.when(d.between(INT_MIN, INT_MAX), d.cast("int")).otherwise(F.lit(None).cast("int"))


def canonical_json(value: Column) -> Column:
    """The JSON document written anew: no white space between its parts, keys of every object in order, escapes and
    numbers in their shortest form; null for text that is no JSON document.

    The text is parsed into a VARIANT and that is written; two texts of the same document become equal.
    """
    return F.to_json(F.try_parse_json(value))
