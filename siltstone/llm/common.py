"""What several of the operators share: tables, texts as bytes, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8."""
    if pa.types.is_null(column.type):
        return [None] * len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def portions(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer row is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``, whole numbers): root is the smallest
    node it is connected with, and a root maps to itself.

    Stars are formed in turns around larger and smaller neighbours, which needs a number of rounds
    that grows with the logarithm of the longest chain. A node with very many neighbours is one row
    per task in the aggregation and a key that adaptive execution may split in the join. Joins are
    merges, as packed edges are a small file long before they are few enough for the driver.
    """
    now = stage(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct(), label)
    before = None
    while (mark := _signature(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u")
        now = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(now.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.distinct())
