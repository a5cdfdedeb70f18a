"""From whatever a source file brings to the columns and types of the contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import Field


def normalize(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Contract names in contract order, by one projection.

    Source names match without regard to case and the first matching source column wins. Columns
    the contract does not know are dropped; contract columns the source lacks are typed NULLs.
    """
    target_of = {source.lower(): f.name for f in fields for source in f.sources}
    position: dict[str, int] = {}
    for at, name in enumerate(df.columns):
        target = target_of.get(name.lower())
        if target is not None:
            position.setdefault(target, at)
    # Positional names: a source may hold two spellings of one name.
    by_position = df.toDF(*[f"c{at}" for at in range(len(df.columns))])
    return by_position.select(
        *[
            F.col(f"c{position[f.name]}").alias(f.name)
            if f.name in position
            else F.lit(None).cast(f.type).alias(f.name)
            for f in fields
        ]
    )


def cast(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Contract types; a value that does not fit becomes NULL, and missing money becomes 0.00."""
    return df.select(
        *[
            F.coalesce(F.col(f.name).try_cast(f.type), F.lit(0).cast(f.type)).alias(f.name)
            if f.money
            else F.col(f.name).try_cast(f.type).alias(f.name)
            for f in fields
        ]
    )
