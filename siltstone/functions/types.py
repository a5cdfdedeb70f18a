"""Which type holds the values of two others."""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest of the usual types that holds what ``a`` and ``b`` hold, text where no other does.

    Whole numbers widen to the larger, whole and floating numbers to double, decimals to one with the
    digits of both, dates to timestamps, and the type of a column that is always NULL to the other's.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    numbers = (*_WHOLE, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, (*numbers, T.DecimalType)) and isinstance(b, (*numbers, T.DecimalType)):
        return T.DoubleType()
    moments = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, moments) and isinstance(b, moments):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()
