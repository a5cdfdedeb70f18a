"""What the jobs that wrote a table counted of its rows, for as long as the table holds those rows.

Every load of a partitioned table has a folder of its own (``tables.load_partitions``). A count made while it was written
belongs to that folder, and holds for the table while the partitions asked for are exactly those that this load wrote, are
still read from there, and hold as many rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

COLUMNS = "target string, load string, written array<string>, rows long, predicate string, observed long"


def keep(spark: SparkSession, log: str, target: str, load: tables.Load, predicates: Mapping[str, str]) -> None:
    """Note what ``load`` counted; ``predicates`` are those of its ``counting``."""
    rows = [(target, _name(load.place), list(load.written), load.rows, predicates[name], n) for name, n in load.counted.items()]
    if rows:
        tables.append(spark.createDataFrame(rows, COLUMNS).coalesce(1), log)


def counts(
    spark: SparkSession, log: str, target: str, table: str, scope: Sequence[str], predicates: Sequence[str], by: str = "load_month"
) -> dict[str, int]:
    """How many rows of the partitions in ``scope`` meet each of the predicates, of those that the loads counted.

    Empty when any of the partitions was written otherwise, was replaced apart from others of its load, or has got or
    lost files since. No column is read: rows are counted by the footers of the files. The driver
    gathers one row for each partition and predicate.
    """
    if not predicates or not spark.catalog.tableExists(log) or not spark.catalog.tableExists(table):
        return {}
    loads: dict[str, set[str]] = {}
    for value, place in tables.locations(spark, table, by, scope).items():
        loads.setdefault(_name(place.rpartition("/")[0]), set()).add(value)
    noted = spark.table(log).where((F.col("target") == target) & F.col("load").isin(*loads)).collect() if loads else []
    rows, found = {}, dict.fromkeys(predicates, 0)
    told = {(note["load"], note["predicate"]): note for note in noted}
    for load, values in loads.items():
        for predicate in list(found):
            note = told.get((load, predicate))
            if note is None:
                del found[predicate]
                continue
            if set(note["written"]) != values:
                return {}
            rows[load] = note["rows"]
            found[predicate] += note["observed"]
    if found and sum(rows.values()) != _held(spark.table(table), by, scope):
        return {}
    return found


def _held(table: DataFrame, by: str, scope: Sequence[str]) -> int:
    return table.where(F.col(by).isin(*scope)).agg(F.count(F.lit(1))).first()[0]


def _name(place: str) -> str:
    return place.rstrip("/").rpartition("/")[2]
