"""Checks that run inside the job they protect instead of in a pass of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def insist(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the job that reads ``df`` as soon as a row does not meet ``condition``."""
    return df.where(F.assert_true(condition, F.lit(message)).isNull())


def unique_rows(df: DataFrame, key: Sequence[str], what: str) -> DataFrame:
    """``df`` with its rows keyed: fails on a repeated or a NULL key.

    Grouping shrinks repeated keys before the shuffle, and the join that follows on the same key
    needs no further exchange.
    """
    rest = [name for name in df.columns if name not in key]
    grouped = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.any_value(F.struct(*rest) if rest else F.lit(True)).alias("_row"),
    )
    present = F.lit(True)
    for name in key:
        present = present & F.col(name).isNotNull()
    checked = insist(grouped, (F.col("_copies") == 1) & present, f"{what}: repeated or NULL key")
    return checked.select(
        *[F.col(name) if name in key else F.col(f"_row.{name}").alias(name) for name in df.columns]
    )


def require_utc(spark: SparkSession) -> None:
    """Ids and calendar keys are built from the text of timestamps, so the zone must be fixed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, it is {zone!r}")
