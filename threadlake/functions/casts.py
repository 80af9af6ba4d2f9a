"""Casts that turn bad input into null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_LAST_SECOND_OF_9999 = 253402300799


# A cast that fails costs an exception per row inside Spark, even when it yields
# null; the patterns keep it to text that will do.


def lenient_double(column: Column) -> Column:
    """Text to double; anything but a plain decimal number becomes null."""
    text = column.cast("string")
    return F.when(text.rlike(_DECIMAL_NUMBER), text.try_cast("double"))


def lenient_long(column: Column) -> Column:
    """Text to bigint. ``1e3`` and ``7.0`` count as whole numbers, ``12.5`` does not.

    Digits alone are cast directly, so ids above 2^53 keep every one.
    """
    text = column.cast("string")
    number = text.try_cast("double")
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint")).when(
        text.rlike(_DECIMAL_NUMBER) & (number == F.floor(number)), number.try_cast("bigint")
    )


def lenient_boolean(column: Column) -> Column:
    word = F.lower(F.trim(column.cast("string")))
    return F.when(word.isin("true", "1", "1.0"), True).when(word.isin("false", "0", "0.0"), False)


def epoch_timestamp(column: Column) -> Column:
    """Seconds since the epoch to a timestamp; out of range or bad becomes null."""
    seconds = lenient_double(column)
    return F.when(
        F.abs(seconds) <= _LAST_SECOND_OF_9999, F.timestamp_seconds(seconds)
    )


def lenient(column: Column, kind: T.DataType, source: T.DataType | None = None) -> Column:
    """``column`` as ``kind``; a column that already has the type passes as is."""
    if source == kind:
        return column
    if isinstance(kind, T.LongType):
        return lenient_long(column)
    if isinstance(kind, T.DoubleType):
        return lenient_double(column)
    if isinstance(kind, T.BooleanType):
        return lenient_boolean(column)
    if isinstance(kind, T.TimestampType):
        if isinstance(source, T.TimestampNTZType):
            return column.cast("timestamp")
        return epoch_timestamp(column)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.LongType):
        if isinstance(source, T.ArrayType):
            return F.transform(column, lenient_long)
        return F.from_json(column, "array<bigint>")
    return column.cast(kind)
