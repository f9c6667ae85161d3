"""Value conversion: text to typed values, and typed values to portable text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The epoch that replaces sentinel instants, the last year-1 instant and
# the first instant that counts as "+infinity".
EPOCH = "1970-01-01 00:00:00"
LOWEST = "0002-01-01 00:00:00"
HIGHEST = "9999-12-31 23:59:59.999999"

# The shapes of a UUID text.
UUID_DASHED = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
UUID_PLAIN = "^[0-9a-fA-F]{32}$"
UUID_ZERO = "00000000-0000-0000-0000-000000000000"

# The texts of a whole number and of a real number. Testing them first spares Spark
# an exception per bad value.
WHOLE_TEXT = r"^\s*[+-]?[0-9]+\s*$"
REAL_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|infinity))\s*$"

# Fixed value: how an ISO date begins. A time alone would be read as a time of today.
ISO_START = "^[0-9]{4}-[0-9]{1,2}"

# Fixed value: the text of an array of whole numbers.
WHOLE_ARRAY = r"^\[\s*((-?[0-9]+|null)\s*(,\s*(-?[0-9]+|null)\s*)*)?\]$"

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def canonical_uuid(column: Column) -> Column:
    """Key text as a lower-case dashed UUID; other shapes and the all-zero key become NULL."""
    digits = F.lower(F.regexp_replace(column, "-", ""))
    dashed = F.concat_ws(
        "-",
        F.substring(digits, 1, 8),
        F.substring(digits, 9, 4),
        F.substring(digits, 13, 4),
        F.substring(digits, 17, 4),
        F.substring(digits, 21, 12),
    )
    return F.nullif(F.when(digits.rlike(UUID_PLAIN), dashed), F.lit(UUID_ZERO))


def to_bigint(text: Column) -> Column:
    """A whole number with a sign and outer blanks allowed; anything else, ``1.5`` too, is NULL."""
    return F.when(text.rlike(WHOLE_TEXT), text.try_cast("bigint"))


def to_whole(text: Column, target: T.DataType) -> Column:
    """A whole number of any width; one that does not fit is NULL."""
    wide = to_bigint(text)
    return wide if isinstance(target, T.LongType) else wide.try_cast(target)


def to_real(text: Column, target: T.DataType) -> Column:
    """A number with exponent, NaN and Infinity allowed; anything else is NULL."""
    return F.when(text.rlike(REAL_TEXT), F.trim(text).try_cast(target))


def to_boolean(text: Column) -> Column:
    """A whole number is true unless 0; ``true``/``false`` in any case; anything else is NULL."""
    word = F.lower(F.trim(text))
    return F.coalesce(to_bigint(text) != 0, F.when(word.isin("true", "false"), word == "true"))


def to_timestamp_utc(text: Column) -> Column:
    """ISO text to an instant; without an offset it is UTC (the session zone). Other forms are NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_START), trimmed.try_cast("timestamp"))


def to_array(text: Column, dtype: T.ArrayType) -> Column:
    """``[..]`` text to an array, else NULL; one bad element makes the whole text bad."""
    trimmed = F.trim(text)
    shaped = trimmed.startswith("[") & trimmed.endswith("]")
    if isinstance(dtype.elementType, WHOLE):
        shaped = trimmed.rlike(WHOLE_ARRAY)
    return F.when(shaped, F.from_json(trimmed, dtype))


def convert(column: Column, source: T.DataType, target: T.DataType, max_length: int | None = None) -> Column:
    """``column`` as ``target``; a value that cannot be read becomes NULL."""
    text = column.cast("string")
    if isinstance(target, T.StringType):
        return F.substring(text, 1, max_length) if max_length else text
    if source == target:
        return column
    if isinstance(target, T.BooleanType):
        return to_boolean(text)
    if isinstance(target, WHOLE):
        if isinstance(source, REAL):
            return F.when(column == F.floor(column), column).try_cast(target)
        return to_whole(text, target)
    if isinstance(target, REAL) and isinstance(source, T.StringType):
        return to_real(text, target)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return column.cast(target)
        instant = to_timestamp_utc(text)
        return instant.cast(target)
    if isinstance(target, T.ArrayType) and isinstance(source, T.StringType):
        return to_array(text, target)
    if isinstance(target, T.BinaryType) and isinstance(source, T.BinaryType):
        return column
    return text.try_cast(target)


def iso_utc(column: Column) -> Column:
    """An instant as ISO text with seven fraction digits and ``Z``."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'")


def finite(column: Column) -> Column:
    """The number, or NULL where it is NaN or infinite."""
    infinite = F.abs(column) == F.lit(float("inf"))
    return F.when(~(F.isnan(column) | infinite), column)


def portable(column: Column, dtype: T.DataType, is_key: bool = False) -> Column:
    """A value in its portable form; text keys stay as they are."""
    if isinstance(dtype, T.BooleanType):
        return column.cast("int")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_utc(column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return finite(column)
    if isinstance(dtype, T.ArrayType):
        return F.to_json(column)
    if isinstance(dtype, T.StringType) and not is_key:
        return F.when(column.rlike(UUID_DASHED), F.upper(column)).otherwise(column)
    return column


def repair_instant(column: Column, sentinel: str = EPOCH, lowest: str = LOWEST, highest: str = HIGHEST) -> Column:
    """Instants outside (``lowest``, ``highest``) stand for "unknown" and become ``sentinel``."""
    bad = (column < F.lit(lowest).cast("timestamp")) | (column >= F.lit(highest).cast("timestamp"))
    return F.when(bad, F.lit(sentinel).cast("timestamp")).otherwise(column)
