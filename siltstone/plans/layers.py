"""Running the layers: raw files to bronze, silver, gold, with quality checks between them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import Domain, Expectation
from ..operators import dimensions, expectations, star
from ..operators.expectations import RESULT_COLUMNS
from ..sources import histories, landing, ledger, measured, tables
from ..sources.workspace import staged
from .silver import tagged_trips

LAYERS = ("bronze", "silver", "gold")
TRACKED = ("borough", "zone", "service_zone", "is_airport")


@dataclass(frozen=True)
class Lakehouse:
    """Where a domain's data comes from and what its tables are called.

    ``raw_root`` holds the raw months as one folder each, every folder with the schema its source
    had. When ``streamed`` is set, months are taken from ``landing`` by the ledger of files
    (``sources.ledger``), which then knows their schemas. ``history_buckets`` divide the open versions of the
    locations. With ``source_table`` the months are cut from that table by ``source_moment`` instead of
    being read from files in ``landing``.
    """

    domain: Domain
    landing: str
    zones: str
    raw_root: str
    service: str = "yellow"
    catalog: str | None = None
    schemas: Mapping[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )
    source_table: str | None = None
    source_moment: str = "tpep_pickup_datetime"
    streamed: bool = False
    history_buckets: int = 1
    clustering: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def table(self, layer: str, name: str) -> str:
        prefix = f"{self.catalog}." if self.catalog else ""
        return f"{prefix}{self.schemas[layer]}.{name}"

    @property
    def valid(self) -> str:
        return self.table("silver", "fct_source_trips")

    @property
    def schemas_table(self) -> str:
        return self.table("bronze", "raw_schemas")

    @property
    def settled(self) -> str:
        return self.table("silver", "settled_rows")

    @property
    def measured(self) -> str:
        return self.table("silver", "measured_rows")

    @property
    def quarantine(self) -> str:
        return self.table("silver", "fct_source_trips_quarantine")

    @property
    def fact(self) -> str:
        return self.table("gold", "fct_trips")


def months_given(months: str | Sequence[str]) -> list[str]:
    """Months as a list, one text of several, or a mixture."""
    given = [months] if isinstance(months, str) else months
    return [month for text in given for month in text.split()]


def read_zone_lookup(spark: SparkSession, lake: Lakehouse) -> str:
    """The zones as landed; returns the name of their table."""
    zones = lake.table("bronze", "raw_taxi_zones")
    tables.full_overwrite(landing.read_zones(spark, lake.zones), zones, "Location lookup as landed")
    return zones


def bronze_layer(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> dict[str, int]:
    """Zones, then each month into its own folder; re-running a month replaces that folder.

    All months of the area together are the view ``raw_trips`` in the schema of bronze.
    """
    counts = {"zones": spark.table(read_zone_lookup(spark, lake)).count()}
    if lake.streamed:
        take_landed(spark, lake, months)
        return counts
    schemas = []
    for month in months:
        if lake.source_table:
            raw = landing.table_month(spark, lake.source_table, lake.source_moment, month)
        else:
            raw = landing.read_month(spark, lake.landing, lake.service, month)
        folder = f"{lake.raw_root.rstrip('/')}/load_month={month}"
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        month_rows = raw.drop("load_month")
        counted = month_rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(folder)
        counts[month] = seen.get["rows"]
        schemas.append((month, landing.schema_text(month_rows)))
    recorded = spark.createDataFrame(schemas, "load_month string, schema string")
    tables.upsert_scd1(recorded, lake.schemas_table, ["load_month"])
    publish(spark, lake)
    return counts


def publish(spark: SparkSession, lake: Lakehouse) -> None:
    """Every raw month as one relation for SQL, whatever schema it came with."""
    if lake.streamed:
        entries = ledger.ledger(spark, lake.raw_root)
    else:
        entries = spark.table(lake.schemas_table)
    # as many rows as there are months
    schemas = {r["load_month"]: r["schema"] for r in entries.groupBy("load_month").agg(F.first("schema").alias("schema")).collect()}
    landing.publish_raw(spark, lake.table("bronze", "raw_trips"), lake.raw_root, schemas)


def unsettled_months(spark: SparkSession, lake: Lakehouse) -> list[str]:
    """Months that have landed otherwise than the ledger has them."""
    return ledger.changed_months(ledger.landed_files(spark, lake.landing), ledger.ledger(spark, lake.raw_root))


def take_landed(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> list[str]:
    """Bring the raw months that landed anew to the ledger; returns those that were taken."""
    taken = ledger.ingest_landed(spark, lake.landing, lake.raw_root, months=months)
    if taken:
        publish(spark, lake)
    return taken


def raw_rows(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> list[DataFrame]:
    """The raw months, read with the schemas that bronze recorded."""
    schemas = {}
    if lake.streamed:
        schemas = ledger.recorded_schemas(spark, lake.raw_root, months)
    elif spark.catalog.tableExists(lake.schemas_table):
        # as many rows as there are months
        schemas = {r["load_month"]: r["schema"] for r in landing.only_months(spark.table(lake.schemas_table), months).collect()}
    return landing.raw_months(spark, lake.raw_root, months, schemas)


def silver_layer(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> dict[str, int]:
    """Accepted and quarantined trips of the months, and the zones.

    The tagged rows are staged once, split by outcome and gathered by month, so that neither
    outcome's write repeats the exchange and sort that removed the copies. A table that is to be
    clustered is ranged on its way out instead of being gathered by month first.
    """
    raw = raw_rows(spark, lake, months)
    outcome = F.when(F.size("_violations") == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
    clustered = "silver.fct_source_trips" in lake.clustering
    landed = sum(df.count() for df in raw)  # from the footers
    tagged = tagged_trips(raw, lake.domain, landed, () if clustered else ["load_month"]).withColumn("_outcome", outcome)
    seen = Observation(f"settled-{uuid.uuid4().hex}")
    # counted by the tasks that write, each of which counts once
    tagged = tagged.observe(seen, *[F.count_if(F.col("load_month") == month).alias(month) for month in months])
    with staged(tagged, "silver", ["_outcome"]) as rows:
        counted = [(month, seen.get[month]) for month in months]
        accepted = rows.where("_outcome = 'accepted'").drop("_outcome", "_violations")
        rejected = rows.where("_outcome = 'rejected'").drop("_outcome")
        counts = {
            "valid": _write(
                accepted, lake, "silver.fct_source_trips", months, comment="Accepted trips", cheap=True
            ),
            "quarantined": tables.replace_partitions(
                rejected.withColumn("_quarantined_at", F.current_timestamp()),
                lake.quarantine,
                months,
                rebalance=clustered,
                comment="Rejected trips and the rules they break",
            ),
        }
    unlike = spark.createDataFrame(counted, "load_month string, distintas long")
    tables.upsert_scd1(unlike.coalesce(1), lake.settled, ["load_month"])
    zones = dimensions.conform_zones(spark.table(lake.table("bronze", "raw_taxi_zones")))
    tables.full_overwrite(zones, lake.table("silver", "dim_source_zones"), "Conformed zones")
    return counts


def _write(
    df: DataFrame, lake: Lakehouse, target: str, months: Sequence[str], comment: str, cheap: bool = False
) -> int:
    """Replace the months of a trip table, in clustered order where the lakehouse asks for one.

    That order asks for the rows more than once: for quantiles, for ranges, and to write them. So they
    are staged first, unless they are ``cheap``, which is to say read from a table as they are. Expectations that
    count rows by a predicate are counted while the rows are written.
    """
    layer, name = target.split(".", 1)
    columns = lake.clustering.get(target)
    table = lake.table(layer, name)
    counting = counted_on_write(lake, target)
    if not columns or cheap:
        ordered = tables.cluster_rows(df, columns) if columns else df
        load = tables.load_partitions(ordered, table, months, rebalance=False, comment=comment, counting=counting)
    else:
        with staged(df, "unordered") as rows:
            ordered = tables.cluster_rows(rows, columns)
            load = tables.load_partitions(ordered, table, months, rebalance=False, comment=comment, counting=counting)
    measured.keep(df.sparkSession, lake.measured, target, load, counting)
    return load.rows


def counted_on_write(lake: Lakehouse, target: str) -> dict[str, str]:
    """The expectations of ``target`` that are counts of rows, with their predicates."""
    return {wanted.name: wanted.predicate for wanted in lake.domain.expectations.get(target, ()) if wanted.predicate}


def gold_layer(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> dict[str, int]:
    """Dimensions, then the fact of the months."""
    write_dimensions(spark, lake, months)
    trips = landing.only_months(spark.table(lake.valid), months)
    return {"fct_trips": write_fact(spark, lake, trips, months)}


def write_fact(spark: SparkSession, lake: Lakehouse, trips: DataFrame, months: Sequence[str]) -> int:
    """The fact of the months; returns its rows.

    Silver arrives by month and the dimension is broadcast while its size allows it, so an unclustered
    fact is then written without any exchange.
    """
    fact = star.located_fact(trips, spark.table(lake.table("gold", "dim_location")), lake.domain)
    return _write(fact, lake, "gold.fct_trips", months, comment="One row per accepted trip")


def read_lookup(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return star.location_lookup(spark.table(lake.table("gold", "dim_location")))


def write_dimensions(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> None:
    """The calendar grown to these months, the fixed dimensions, and a load of the locations."""
    domain = lake.domain
    trips = landing.only_months(spark.table(lake.valid), months)
    _extend_calendar(spark, lake, trips, months)
    tables.full_overwrite(
        dimensions.clock(spark), lake.table("gold", "dim_time"), "One row per minute of the day"
    )
    for name, codes in (
        ("dim_vendor", domain.vendors),
        ("dim_rate_code", domain.rate_codes),
        ("dim_payment_type", domain.payment_types),
    ):
        tables.full_overwrite(dimensions.code_dimension(spark, codes), lake.table("gold", name))
    zones = spark.table(lake.table("silver", "dim_source_zones"))
    histories.load_versions(
        dimensions.locations(zones, domain.airport_pattern),
        lake.table("gold", "dim_location"),
        ["location_id"],
        TRACKED,
        f"{min(months)}-01",
        buckets=lake.history_buckets,
    )


def _extend_calendar(
    spark: SparkSession, lake: Lakehouse, trips: DataFrame, months: Sequence[str]
) -> None:
    """The calendar grows to cover these months and keeps what it covered before."""
    table = lake.table("gold", "dim_date")
    month_ends = spark.range(1).select(
        F.lit(f"{min(months)}-01").cast("date").alias("first_day"),
        F.last_day(F.lit(f"{max(months)}-01").cast("date")).alias("last_day"),
    )
    covered = dimensions.calendar_bounds(trips).unionByName(month_ends)
    if spark.catalog.tableExists(table):
        covered = covered.unionByName(
            spark.table(table).agg(
                F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day")
            )
        )
    bounds = covered.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    tables.full_overwrite(dimensions.calendar(bounds), table, "One row per day")


def read_star(spark: SparkSession, lake: Lakehouse) -> star.Star:
    def gold(name: str) -> DataFrame:
        return spark.table(lake.table("gold", name))

    return star.Star(
        fact=gold("fct_trips"),
        dates=gold("dim_date"),
        clock=gold("dim_time"),
        locations=histories.read_versions(spark, lake.table("gold", "dim_location")),
        vendors=gold("dim_vendor"),
        rate_codes=gold("dim_rate_code"),
        payment_types=gold("dim_payment_type"),
    )


def check_layer(
    spark: SparkSession, lake: Lakehouse, target: str, months: Sequence[str], run_id: str
) -> list[dict]:
    """Evaluate, record, and only then enforce the expectations of ``target``.

    Those that count rows by a predicate are taken from the job that wrote the rows, as long as the table holds just
    these; the others, such as of repeated ids and orphans, ask the tables.
    """
    wanted = lake.domain.expectations.get(target, ())
    if not wanted:
        return []
    silver = landing.only_months(spark.table(lake.valid), months)
    prefix = f"{lake.catalog}." if lake.catalog else ""
    if not target.startswith("gold."):
        names = {"catalog_prefix": prefix, "table": silver}
        return _record(spark, lake, wanted, target, run_id, names, months)
    checked = read_star(spark, lake).in_months(months)
    gaps = star.rowcount_gap(checked.fact, silver)
    # Several expectations ask for these; the fact is scanned for them once.
    with staged(star.orphans(checked), "orphans") as orphans, staged(gaps, "gaps") as gaps:
        names = {"catalog_prefix": prefix, "table": checked.fact, "orphans": orphans, "gaps": gaps}
        return _record(spark, lake, wanted, target, run_id, names, months)


def settle(spark: SparkSession, lake: Lakehouse, months: Sequence[str]) -> None:
    """Stop the run when rows of a month are unaccounted for between raw and silver.

    The rows that were left without their copies were counted by the job that found them; the tables must hold as
    many, and raw no fewer. Nothing is read again: what the raw months and the tables hold is
    counted from the footers of their files.
    """
    by_month = ["load_month"]
    raw = [df.groupBy(*by_month).agg(F.count(F.lit(1)).alias("brutas")) for df in raw_rows(spark, lake, months)]
    raw = reduce(DataFrame.unionByName, raw).groupBy(*by_month).agg(F.sum("brutas").alias("brutas"))
    held = [landing.only_months(spark.table(t), months).select(*by_month) for t in (lake.valid, lake.quarantine)]
    held = held[0].unionByName(held[1]).groupBy(*by_month).agg(F.count(F.lit(1)).alias("gravadas"))
    told = landing.only_months(spark.table(lake.settled), months).join(raw, by_month, "left").join(held, by_month, "left")
    rows, kept = F.coalesce("brutas", F.lit(0)), F.coalesce("gravadas", F.lit(0))
    gap = F.when(rows < F.col("distintas"), F.col("distintas") - rows).otherwise(F.col("distintas") - kept)
    # as many rows as there are months
    broken = told.select("load_month", gap.alias("diferenca")).where("diferenca <> 0").orderBy("load_month").collect()
    if broken:
        gaps = ", ".join(f"{r['load_month']}: {r['diferenca']}" for r in broken)
        raise expectations.ExpectationFailed(f"rows unaccounted for between bronze and silver ({gaps})")


def _record(
    spark: SparkSession,
    lake: Lakehouse,
    wanted: Sequence[Expectation],
    target: str,
    run_id: str,
    names: Mapping[str, str | DataFrame],
    months: Sequence[str],
) -> list[dict]:
    predicates = counted_on_write(lake, target)
    held = measured.counts(spark, lake.measured, target, lake.table(*target.split(".", 1)), months, list(predicates.values()))
    counted = {name: held[predicate] for name, predicate in predicates.items() if predicate in held}
    found = expectations.evaluate(spark, wanted, target, run_id, names, counted)
    # As many rows as there are expectations.
    rows = found.collect()
    history = spark.createDataFrame(rows, found.schema).select(*RESULT_COLUMNS)
    tables.append(history, lake.table("gold", "dq_results"))
    expectations.gate(rows, target)
    return [row.asDict() for row in rows]


def create_schemas(spark: SparkSession, lake: Lakehouse) -> None:
    for schema in LAYERS:
        prefix = f"{lake.catalog}." if lake.catalog else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{lake.schemas[schema]}")


def run_layers(
    spark: SparkSession,
    lake: Lakehouse,
    months: str | Sequence[str],
    layer: str = "all",
    skip_quality: bool = False,
) -> dict[str, dict[str, int]]:
    """One layer or all of them for the given months; returns the rows each of them wrote."""
    if layer != "all" and layer not in LAYERS:
        raise ValueError(f"layer must be one of {(*LAYERS, 'all')}, not {layer!r}")
    months = months_given(months)
    run_id = uuid.uuid4().hex[:8]
    create_schemas(spark, lake)
    chosen = LAYERS if layer == "all" else (layer,)
    counts: dict[str, dict[str, int]] = {}
    for name in chosen:
        if name == "bronze":
            counts[name] = bronze_layer(spark, lake, months)
        elif name == "silver":
            counts[name] = silver_layer(spark, lake, months)
            if not skip_quality:
                settle(spark, lake, months)
                check_layer(spark, lake, "silver.fct_source_trips", months, run_id)
        else:
            counts[name] = gold_layer(spark, lake, months)
            if not skip_quality:
                check_layer(spark, lake, "gold.fct_trips", months, run_id)
    return counts
