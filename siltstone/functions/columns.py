"""Column expressions the operators share. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = -1


def blank_to_null(column: Column) -> Column:
    """NULL, '' and a run of spaces all mean that there is no value."""
    return F.nullif(F.trim(column), F.lit(""))


def natural_id(key: Sequence[str]) -> Column:
    """SHA-256 over the text of the key columns, so a re-run gives a row the same id.

    Fixed values: the separator, the mark of a NULL and the width of the hash.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in key]
    return F.sha2(F.concat_ws("||", *parts), 256)


def date_key(moment: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic: no text is formatted per row."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def time_key(moment: Column) -> Column:
    """HHmm as an integer."""
    return (F.hour(moment) * 100 + F.minute(moment)).cast("int")


def listed_or_unknown(code: Column, listed: Iterable[int]) -> Column:
    """The code itself when the dimension lists it, else the key of the unknown member."""
    return F.when(code.isin(*listed), code).otherwise(F.lit(UNKNOWN_KEY))


def version_key(business_key: Sequence[Column], effective_from: Column) -> Column:
    """Surrogate of one version: two versions of a member never share it."""
    text = [part.cast("string") for part in business_key]
    return F.xxhash64(*text, effective_from.cast("string"))


def content_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's content.

    xxhash64 passes over NULLs, so the NULL flags are hashed as well: a value that moves from
    one column to its neighbour must not look unchanged.
    """
    flags = [F.col(name).isNull() for name in columns]
    return F.xxhash64(*[F.col(name) for name in columns], *flags)


def units(column: Column, digits: int) -> Column:
    """A double already rounded to ``digits`` decimals, as a whole number of its last place.

    Sums of these are exact in any order, which sums of doubles are not, and they stay on
    primitive longs.
    """
    return F.floor(column * F.lit(float(10**digits)) + F.lit(0.5))


def mean_of_units(total: Column, rows: Column, digits: int, rounded_to: int) -> Column:
    """Half-up rounded mean of a sum of ``units``; NULL for an empty group."""
    whole = total.cast("decimal(20,0)")
    parts = (rows * F.lit(10**digits)).cast("decimal(20,0)")
    return F.round(whole / F.nullif(parts, F.lit(0).cast("decimal(20,0)")), rounded_to).cast("double")


def mean_of_money(total: Column, rows: Column, rounded_to: int = 2) -> Column:
    """Half-up rounded mean of a decimal sum; NULL for an empty group."""
    count = rows.cast("decimal(16,0)")
    return F.round(
        total.cast("decimal(20,2)") / F.nullif(count, F.lit(0).cast("decimal(16,0)")), rounded_to
    ).cast("double")
