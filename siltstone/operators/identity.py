"""Deterministic ids, and one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import natural_id
from ..functions.guards import require_utc


def add_trip_id(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    require_utc(df.sparkSession)
    return df.withColumn("trip_id", natural_id(natural_key))


ROWS_PER_TASK = 250_000  #: of about 600 bytes, which are sorted in memory
_EXACT = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType)


def copy_key(df: DataFrame, natural_key: Sequence[str]) -> list[str] | None:
    """The columns that tell rows apart as their ``trip_id`` does, or None where only its text can.

    A value of these types has one text and a text one value, so the 64 characters need not travel and be compared.
    """
    return list(natural_key) if all(isinstance(df.schema[name].dataType, _EXACT) for name in natural_key) else None


def dealt(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df`` dealt by ``key`` among tasks of so many rows that each can sort its own in memory.

    Their number follows ``rows`` and not the bytes that an exchange writes, which adaptive execution goes by:
    conformed rows take many times that in memory. Few rows are left to adaptive execution, which gives every core some.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return df.repartition(tasks, *key) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def keep_latest(
    df: DataFrame,
    key: Sequence[str] = ("trip_id", "load_month"),
    latest: str = "_ingested_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The last ingested copy of every key.

    Copies ingested at the same moment are ranked by ``tie_break`` and then by every other column,
    so the survivor does not depend on how the input was partitioned. Spark limits each key to its
    first row before the exchange as well as after it, so a key with very many copies sends one
    row per input task. The id leads the key because its first bytes tell rows apart when sorting.
    """
    ranked = [name for name in tie_break if name not in (*key, latest)]
    ranked += [name for name in df.columns if name not in (*key, latest, *ranked)]
    best_first = [F.col(latest).desc_nulls_last(), *[F.col(n).asc_nulls_last() for n in ranked]]
    copy = F.row_number().over(Window.partitionBy(*key).orderBy(*best_first))
    return df.withColumn("_copy", copy).where(F.col("_copy") == 1).drop("_copy")
