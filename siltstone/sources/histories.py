"""Tables of versions whose loads may come late, and write what they change.

A table of versions has two partition columns. Open versions lie in buckets of their key, closed ones by the
day after their end, which is the day of the load that closed them. A load rewrites the
buckets in which it changes a version, and the one day of closed versions it makes. Beside the table, ``{table}_loads``
keeps what each load listed: a load that is not the latest has the history of its members made again from
there, so loads in any order, and repeated ones, give one history.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.guards import unique_rows
from ..operators.history import LOW_DATE, _widened, scd2_changes, scd2_history
from . import tables
from .workspace import stage

STATE, PART = "version_state", "version_part"
LOADED = "loaded_on"
BUCKETS = "siltstone.buckets"  #: table property


def read_versions(spark: SparkSession, table: str) -> DataFrame:
    """The versions without the columns of their layout."""
    return spark.table(table).drop(STATE, PART)


def _placed(versions: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    bucket = F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), 6, "0")
    return versions.withColumns(
        {
            STATE: F.when(F.col("is_current"), F.lit("open")).otherwise(F.lit("closed")),
            PART: F.when(F.col("is_current"), bucket).otherwise(F.date_add("effective_to", 1).cast("string")),
        }
    )


def _buckets(spark: SparkSession, table: str) -> int:
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if BUCKETS not in told:
        raise ValueError(f"{table} is not a table of open and closed versions")
    return int(told[BUCKETS])


def _enter(load: DataFrame, log: str, keys: Sequence[str], day: str) -> None:
    """The load in the log. Of a day that was loaded before, members the load does not list stay."""
    spark = load.sparkSession
    if spark.catalog.tableExists(log):
        old = spark.table(log).where(F.col(LOADED) == day).drop(LOADED)
        old = _widened(old, load, "history load")
        load = old.join(load.select(*keys), list(keys), "left_anti").unionByName(load)
    tables.replace_partitions(load.withColumn(LOADED, F.lit(day)), log, [day], by=LOADED)


def _within(parts: Sequence[dict[str, str]]) -> Column:
    """Rows of some partitions; only their folders are read."""
    return F.lit(False) if not parts else F.concat_ws("/", STATE, PART).isin(*[f"{p[STATE]}/{p[PART]}" for p in parts])


def _rewrite(table: str, keys: Sequence[str], changes: DataFrame, buckets: int) -> list[str]:
    """Take the versions marked ``_gone`` out of the table and put the others in; returns the partitions written."""
    spark = changes.sparkSession
    placed = stage(_placed(changes, keys, buckets), "versions")
    identity = [*keys, "effective_from"]
    # at most all buckets and as many days as there are loads
    touched = [r.asDict() for r in placed.select(STATE, PART).distinct().orderBy(STATE, PART).collect()]
    if not touched:
        return []
    added = placed.where("NOT _gone").drop("_gone")
    kept = _widened(spark.table(table).where(_within(touched)), added, "history load")
    kept = kept.join(placed.select(*identity), identity, "left_anti")
    fit, wider = tables.fitted(kept.unionByName(added), table)
    seen = Observation(f"versions-{uuid.uuid4().hex}")
    counted = fit.hint("rebalance", STATE, PART).observe(seen, F.collect_set(F.concat_ws("/", STATE, PART)).alias("filled"))
    place = tables.write_load(counted, table, [STATE, PART])
    tables.widen(spark, table, wider)
    filled = set(seen.get["filled"])
    full = [p for p in touched if f"{p[STATE]}/{p[PART]}" in filled]  # closed ones come first
    tables.point_partitions(spark, table, place, full, [p for p in touched if p not in full])
    return [f"{p[STATE]}/{p[PART]}" for p in touched]


def load_versions(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    day: str,
    surrogate: str = "location_key",
    buckets: int = 16,
    open_from: str | None = LOW_DATE,
) -> list[str]:
    """Load ``df`` as of ``day`` into a table of versions; returns the partitions that were written.

    Loads may come in any order, and again: the history is that of ``scd2_history`` over all of them. Only partitions
    with a changed version are written, so a load that changes nothing writes none but its entry in the log. A load that
    is later than all others reads the open versions alone. ``buckets`` counts when the table is made; what was made
    keeps its number. A NULL or repeated key fails the load before anything is written. Stopped between two partitions, a load is
    completed by being repeated.
    """
    spark = df.sparkSession
    keys, tracked = list(keys), list(tracked)
    log = f"{table}_loads"
    rest = [name for name in df.columns if name not in (*keys, *tracked)]
    load = stage(unique_rows(df.select(*keys, *tracked, *rest), keys, "history load"), "load")
    exists = spark.catalog.tableExists(table)
    if exists:
        buckets = _buckets(spark, table)
    days = [values[LOADED] for values in tables.partitions(spark, log).values()] if spark.catalog.tableExists(log) else []
    _enter(load, log, keys, day)
    listed = spark.table(log)
    if not exists:
        first = _placed(scd2_history(listed.join(load.select(*keys), keys, "left_semi"), keys, tracked, LOADED, surrogate, open_from), keys, buckets)
        tables.create(first, table, [STATE, PART], None)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS}' = '{buckets}')")
    if exists and all(known < day for known in days):
        current = spark.table(table).where(F.col(STATE) == "open").drop(STATE, PART)
        changes = scd2_changes(current, load, keys, tracked, day, surrogate, open_from)
    else:
        mine = load.select(*keys)
        new = scd2_history(listed.join(mine, keys, "left_semi"), keys, tracked, LOADED, surrogate, open_from)
        old = _widened(spark.table(table).drop(STATE, PART), new, "history load").join(mine, keys, "left_semi").select(*new.columns)
        gone = old.exceptAll(new).withColumn("_gone", F.lit(True))
        changes = gone.unionByName(new.exceptAll(old).withColumn("_gone", F.lit(False)))
    return _rewrite(table, keys, changes, buckets)
