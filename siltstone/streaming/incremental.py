"""Only what is new: files as they land, and changed rows on their way to the fact."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..contracts import Domain
from ..functions.guards import insist
from ..operators.history import snapshot_diff
from ..operators.star import build_fact
from ..plans import layers
from ..sources import tables
from ..sources.landing import FILE_MONTH, only_months
from ..sources.ledger import ingest_landed
from ..sources.tables import replace_partitions
from ..sources.workspace import staged

ROW_KEY = ("load_month", "trip_id")
INCREMENTS = "increments"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    raw_root: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Take every landed file the checkpoint has not seen yet, then stop.

    The stream brings the names of new files; the months they belong to are read from all their files and
    replace their raw folders (``ledger.ingest_landed``), so no column a file has beyond ``schema`` is lost, and
    a month that lands again under other names is not there twice. The ledger makes a repeated batch do nothing.
    A file without a month in its name fails the batch. A file that is written anew under its old name is
    no new file for a stream: ``ingest_landed`` finds it by its time and size.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select(F.regexp_extract("path", FILE_MONTH, 1).alias("load_month"))
    )

    def take(batch: DataFrame, _: int) -> None:
        named = insist(batch, F.col("load_month") != "", "landed file without a month in its name")
        # as many rows as there are months
        months = sorted(r["load_month"] for r in named.distinct().collect())
        if months:
            ingest_landed(batch.sparkSession, landing, raw_root, wanted, months)

    return names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refreshed_fact(
    fact: DataFrame, changes: DataFrame, silver: DataFrame, lookup: DataFrame, domain: Domain
) -> DataFrame:
    """``fact`` brought up to ``silver`` by rebuilding only the rows listed in ``changes``."""
    keys = list(ROW_KEY)
    replaced = changes.select(*keys)
    rebuilt = silver.join(changes.where("change <> 'removed'").select(*keys), keys, "left_semi")
    return fact.join(replaced, keys, "left_anti").unionByName(build_fact(rebuilt, lookup, domain))


def refresh_fact(
    fact_table: str, before: DataFrame, after: DataFrame, lookup: DataFrame, domain: Domain
) -> Sequence[str]:
    """Apply the difference of two silver snapshots to the months of the fact it touches."""
    spark = before.sparkSession
    with staged(snapshot_diff(before, after, ROW_KEY), "changes") as changes:
        # As many rows as there are months.
        months = [r["load_month"] for r in changes.select("load_month").distinct().collect()]
        if months:
            touched = F.col("load_month").isin(*months)
            updated = refreshed_fact(
                spark.table(fact_table).where(touched), changes, after.where(touched), lookup, domain
            )
            replace_partitions(updated, fact_table, months)
    return sorted(months)


def _increments(lake: layers.Lakehouse) -> str:
    return lake.table("silver", INCREMENTS)


def _open_increment(spark: SparkSession, lake: layers.Lakehouse) -> list[dict]:
    """The months of the increment that has not come to its end, and where they were read from before it."""
    if not spark.catalog.tableExists(_increments(lake)):
        return []
    # one increment is open at most; as many rows as it has months
    return [r.asDict() for r in spark.table(_increments(lake)).where("step <> 'done'").orderBy("load_month").collect()]


def _note(spark: SparkSession, lake: layers.Lakehouse, rows: Sequence[dict], step: str) -> None:
    noted = [(r["increment"], r["load_month"], r["before"], r["zones"], step) for r in rows]
    df = spark.createDataFrame(noted, "increment string, load_month string, before string, zones string, step string")
    tables.upsert_scd1(df.coalesce(1), _increments(lake), ["increment", "load_month"])


def _silver_before(spark: SparkSession, lake: layers.Lakehouse, rows: Sequence[dict]) -> DataFrame:
    """The silver months as they were when the increment began, read from the folders they had then."""
    schema = spark.table(lake.valid).schema
    plain = StructType([f for f in schema.fields if f.name != "load_month"])
    out = spark.createDataFrame([], schema)
    for r in rows:
        if r["before"]:
            month = spark.read.schema(plain).parquet(r["before"]).withColumn("load_month", F.lit(r["load_month"]))
            out = out.unionByName(month.select(*schema.names))
    return out


def _versions(spark: SparkSession, lake: layers.Lakehouse) -> str:
    """A digest of the location versions; only whether it changes counts."""
    name = lake.table("gold", "dim_location")
    if not spark.catalog.tableExists(name):
        return ""
    held = F.xxhash64("location_id", "location_key", "effective_from", "effective_to").cast("decimal(38,0)")
    return str(spark.table(name).agg(F.count(F.lit(1)), F.sum(held)).first())


def run_increment(spark: SparkSession, lake: layers.Lakehouse, skip_quality: bool = False) -> dict[str, list[str]]:
    """Take what has landed through all layers: only its months, and in the fact only its changed rows.

    Returns the months of each layer that were written: nothing has landed, nothing is done. An increment is
    noted before its first step with the folders of the silver months as they are then. These stay readable until the
    fact is written, as partitions are replaced by pointing them elsewhere. A run that stops anywhere is
    taken up by the next one, which compares with the same folders, so each change reaches the fact once: a
    step that is repeated finds its work done and writes the same rows.

    The fact keeps the rows of a month whose trips did not change. Where the location versions change with this
    increment, its months are built anew.
    """
    layers.create_schemas(spark, lake)
    rows = _open_increment(spark, lake)
    done: dict[str, list[str]] = {"bronze": [], "silver": [], "gold": []}
    if not rows:
        layers.read_zone_lookup(spark, lake)
        pending = layers.unsettled_months(spark, lake)
        if not pending:
            return done
        known = spark.catalog.tableExists(lake.valid)
        name, zones = uuid.uuid4().hex, _versions(spark, lake)
        rows = [
            {
                "increment": name,
                "load_month": month,
                "before": tables.partition_location(spark, lake.valid, load_month=month) if known else None,
                "zones": zones,
            }
            for month in pending
        ]
        _note(spark, lake, rows, "begun")
    months = [r["load_month"] for r in rows]
    steps = {r.get("step", "begun") for r in rows}
    if steps == {"begun"}:
        done["bronze"] = layers.take_landed(spark, lake, months)
        layers.silver_layer(spark, lake, months)
        if not skip_quality:
            layers.settle(spark, lake, months)
            layers.check_layer(spark, lake, "silver.fct_source_trips", months, rows[0]["increment"][:8])
        done["silver"] = months
        _note(spark, lake, rows, "silver")
    layers.write_dimensions(spark, lake, months)
    after = only_months(spark.table(lake.valid), months)
    if spark.catalog.tableExists(lake.fact) and _versions(spark, lake) == rows[0]["zones"]:
        done["gold"] = list(refresh_fact(lake.fact, _silver_before(spark, lake, rows), after, layers.read_lookup(spark, lake), lake.domain))
    else:
        layers.write_fact(spark, lake, after, months)
        done["gold"] = months
    if not skip_quality:
        layers.check_layer(spark, lake, "gold.fct_trips", months, rows[0]["increment"][:8])
    _note(spark, lake, rows, "done")
    return done
