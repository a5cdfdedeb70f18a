"""The queries the driver runs: every operator over the whole of the given tables.

Operators that start from raw rows are one plan from the given Parquet files. Queries over the
star read layers that were written once per session and folder, as they would on a cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.contracts import Domain, Expectation
from siltstone.domains.events import EVENTS, raw_events, source_events
from siltstone.domains.shipments import SHIPMENTS, raw_places, raw_shipments
from siltstone.operators import dimensions, expectations, history, rules, star
from siltstone.operators.conform import cast, normalize
from siltstone.operators.identity import add_trip_id, keep_latest
from siltstone.operators.metrics import derive
from siltstone.plans import marts
from siltstone.plans.layers import TRACKED, Lakehouse, run_layers
from siltstone.plans.silver import conform, prepare, tagged_trips
from siltstone.sources import histories, landing, measured, tables
from siltstone.sources.ledger import ingest_landed, recorded_schemas
from siltstone.sources.workspace import fresh_folder, stage
from siltstone.streaming.incremental import ingest_new_files, refreshed_fact, run_increment

Query = Callable[[SparkSession, str], DataFrame]
CHANGE_DAY = {"shipments": "1998-06-01", "events": "2024-01-15"}
RAW = {"shipments": raw_shipments, "events": raw_events}
DOMAINS = {"shipments": SHIPMENTS, "events": EVENTS}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_database(spark: SparkSession) -> str:
    """A schema of its own for one query, in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{fresh_folder(spark, name)}'")
    return name


def two_version_locations(spark: SparkSession, folder: str, change_day: str, pattern: str) -> DataFrame:
    """The location dimension after a second load that renamed every fifth place."""
    zones = dimensions.conform_zones(raw_places(spark, folder))
    first = dimensions.locations(zones, pattern)
    renamed = first.withColumn(
        "zone",
        F.when(
            (F.col("location_id") % 5 == 0) & (F.col("location_id") >= 0),
            F.concat("zone", F.lit(" NEW")),
        ).otherwise(F.col("zone")),
    ).withColumn("is_airport", F.col("zone").rlike(pattern))
    key = ["location_id"]
    opened = history.scd2_merge(None, first, key, TRACKED, "1995-01-01")
    return history.scd2_merge(opened, renamed, key, TRACKED, change_day)


class Layers:
    """The written silver and gold layers of one domain."""

    def __init__(self, spark: SparkSession, folder: str, name: str) -> None:
        self.spark, self.folder, self.name = spark, folder, name
        self.domain: Domain = DOMAINS[name]

    @cached_property
    def raw(self) -> DataFrame:
        return RAW[self.name](self.spark, self.folder)

    @cached_property
    def tagged(self) -> DataFrame:
        outcome = F.when(F.size("_violations") == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
        rows = tagged_trips(self.raw, self.domain, gather=["load_month"]).withColumn("_outcome", outcome)
        return stage(rows, "silver", ("_outcome", "load_month"))

    @property
    def valid(self) -> DataFrame:
        return self.tagged.where("_outcome = 'accepted'").drop("_outcome", "_violations")

    @property
    def quarantine(self) -> DataFrame:
        return self.tagged.where("_outcome = 'rejected'").drop("_outcome")

    @cached_property
    def locations(self) -> DataFrame:
        return stage(
            two_version_locations(
                self.spark, self.folder, CHANGE_DAY[self.name], self.domain.airport_pattern
            ),
            "locations",
        )

    @cached_property
    def star(self) -> star.Star:
        lookup = star.location_lookup(self.locations)
        fact = stage(star.build_fact(self.valid, lookup, self.domain), "fact", ("load_month",))
        dates = dimensions.calendar(dimensions.calendar_bounds(self.valid))
        return star.Star(
            fact=fact,
            dates=stage(dates, "dates"),
            clock=dimensions.clock(self.spark),
            locations=self.locations,
            vendors=dimensions.code_dimension(self.spark, self.domain.vendors),
            rate_codes=dimensions.code_dimension(self.spark, self.domain.rate_codes),
            payment_types=dimensions.code_dimension(self.spark, self.domain.payment_types),
        )


_LAYERS: dict[tuple[str, str, str], Layers] = {}


def layers(spark: SparkSession, folder: str, name: str) -> Layers:
    key = (spark.sparkContext.applicationId, folder, name)
    return _LAYERS.setdefault(key, Layers(spark, folder, name))


def shipped(spark: SparkSession, folder: str) -> Layers:
    return layers(spark, folder, "shipments")


def evented(spark: SparkSession, folder: str) -> Layers:
    return layers(spark, folder, "events")


# --- bronze ---------------------------------------------------------------------------------


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    raw = landing.with_lineage(read(spark, folder, "lineitem"), "1995-01", "batch")
    return raw.drop("_ingested_at").withColumn(
        "_source_file", F.element_at(F.split("_source_file", "/"), -1)
    )


def bronze_lineage(spark: SparkSession, folder: str) -> DataFrame:
    raw = read(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM").alias("load_month"),
        F.concat(F.lit("batch-"), "event_type").alias("_batch_id"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
    )
    return landing.batches(raw)


def messy_places(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a location lookup with every flaw the conforming has to repair."""
    key = F.col("c_custkey")
    return read(spark, folder, "customer").select(
        F.when(key % 97 == 0, F.lit("x")).otherwise(F.floor(key / 2).cast("string")).alias("LocationID"),
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 7 == 1, F.lit("  "))
        .when(key % 7 == 2, F.lit("unknown"))
        .when(key % 7 == 3, F.lit("N/A"))
        .otherwise(F.col("c_mktsegment"))
        .alias("Borough"),
        F.when(key % 5 == 0, F.lit(" "))
        .when(key % 11 == 0, F.concat(F.lit(" Airport "), "c_name"))
        .otherwise(F.col("c_name"))
        .alias("Zone"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("service_zone"),
    )


def landed_places(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "places")
    (
        messy_places(spark, folder)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return landing.read_zones(spark, path)


def bronze_csv_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return landed_places(spark, folder).drop("_ingested_at")


def silver_zones(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.conform_zones(landed_places(spark, folder))


def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    zones = dimensions.conform_zones(landed_places(spark, folder))
    versioned = history.scd2_merge(
        None, dimensions.locations(zones, "(?i)(JFK|LaGuardia|Newark|Airport)"),
        ["location_id"], TRACKED, "2024-01-01",
    )
    return versioned.drop("location_key", "row_hash")


def months_of(df: DataFrame, moment: str) -> list[str]:
    """The months that occur; the driver gathers as many rows as there are months."""
    found = df.where(F.col(moment).isNotNull()).select(F.date_format(moment, "yyyy-MM").alias("month")).distinct()
    return sorted(r["month"] for r in found.collect()) or ["1970-01"]


def table_source(spark: SparkSession, folder: str) -> DataFrame:
    database = scratch_database(spark)
    spark.sql(
        f"CREATE TABLE {database}.samples USING parquet LOCATION '{folder}/events.parquet'"
    )
    source = f"{database}.samples"
    months = [landing.table_month(spark, source, "ts", m, "batch") for m in months_of(spark.table(source), "ts")]
    whole = reduce(DataFrame.unionByName, months)
    return whole.select("event_id", "ts", "user_id", "event_type", "value", "load_month")


def months_scan(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["1995-03", "1996-01", "1996-02", "1999-12"]
    return landing.only_months(shipped(spark, folder).valid, wanted).select(
        "trip_id", "order_key", "line_number", "total_amount", "load_month"
    )


# --- silver ---------------------------------------------------------------------------------


def silver_normalize(spark: SparkSession, folder: str) -> DataFrame:
    out = normalize(raw_shipments(spark, folder), SHIPMENTS.fields)
    return out.select(
        "order_key", "line_number", "vendor_id", "pickup_datetime", "dropoff_datetime",
        "trip_distance_mi", "pu_location_id", "do_location_id", "payment_type_id",
        F.col("extra_amount").isNull().alias("extra_missing"), "load_month",
    )


def silver_cast(spark: SparkSession, folder: str) -> DataFrame:
    fields = SHIPMENTS.fields
    return cast(normalize(raw_shipments(spark, folder), fields), fields).drop(
        "_ingested_at", "_source_file", "_batch_id"
    )


DERIVED = (
    "trip_duration_min", "trip_distance_km", "avg_speed_kmh", "tip_pct", "pickup_date",
    "pickup_hour", "is_airport_trip",
)


def silver_derive(spark: SparkSession, folder: str) -> DataFrame:
    return derive(conform(raw_events(spark, folder), EVENTS)).select("event_id", *DERIVED)


def trip_id(spark: SparkSession, folder: str) -> DataFrame:
    key = [
        "vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
        "total_amount", "passenger_count",
    ]
    typed = conform(raw_shipments(spark, folder), SHIPMENTS)
    return add_trip_id(typed, key).select("trip_id", "order_key", "line_number")


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    typed = add_trip_id(conform(raw_shipments(spark, folder), SHIPMENTS), SHIPMENTS.natural_key)
    return keep_latest(typed, tie_break=SHIPMENTS.tie_break).select(
        "trip_id", "order_key", "line_number", "part_key", "supplier_key", "list_amount",
        "dropoff_datetime", "load_month",
    )


def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tagged_trips(raw_shipments(spark, folder), SHIPMENTS)
    return tagged.select("trip_id", F.array_join("_violations", ",").alias("violations"))


SPLIT = ("trip_id", "order_key", "line_number", "trip_duration_min", "trip_distance_km", "total_amount", "load_month")


def split_valid(spark: SparkSession, folder: str) -> DataFrame:
    return rules.accepted(tagged_trips(raw_shipments(spark, folder), SHIPMENTS)).select(*SPLIT)


def split_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rules.quarantined(tagged_trips(raw_shipments(spark, folder), SHIPMENTS))
    return rejected.select(*SPLIT, F.array_join("_violations", ",").alias("violations"))


def silver_flow(spark: SparkSession, folder: str) -> DataFrame:
    tagged = rules.tag(prepare(raw_events(spark, folder), EVENTS), EVENTS.rules)
    return tagged.select(
        "event_id", "trip_id", "fare_amount", "tip_amount", "total_amount", *DERIVED,
        (F.size("_violations") == 0).alias("accepted"),
    )


def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quarantine_reasons(shipped(spark, folder).quarantine)


def quarantine_sample(spark: SparkSession, folder: str) -> DataFrame:
    sample = rules.quarantine_sample(
        shipped(spark, folder).quarantine, "distance_positive", order=("order_key", "line_number", "load_month")
    )
    return sample.select("order_key", "line_number", "trip_distance_mi", "load_month")


def reconcile_layers(spark: SparkSession, folder: str) -> DataFrame:
    side = shipped(spark, folder)
    raw = add_trip_id(conform(side.raw, SHIPMENTS), SHIPMENTS.natural_key)
    return rules.reconcile(raw, side.valid, side.quarantine)


# --- dimensions -----------------------------------------------------------------------------


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    typed = derive(conform(raw_shipments(spark, folder), SHIPMENTS))
    return dimensions.calendar(dimensions.calendar_bounds(typed))


def calendar_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.calendar_bounds(shipped(spark, folder).valid)


def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    """The clock, with the events that start in each minute."""
    started = F.col("ts").cast("timestamp")
    used = (
        read(spark, folder, "events")
        .groupBy((F.hour(started) * 100 + F.minute(started)).alias("time_key"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return dimensions.clock(spark).join(used, "time_key", "left").fillna(0, ["events"])


def dim_static(spark: SparkSession, folder: str) -> DataFrame:
    """The three code dimensions, with the trips that use each member."""
    whole = shipped(spark, folder).star
    found = None
    for name, members, key, label in (
        ("vendor", whole.vendors, "vendor_key", "vendor_name"),
        ("rate_code", whole.rate_codes, "rate_code_key", "rate_code_name"),
        ("payment_type", whole.payment_types, "payment_type_key", "payment_type_name"),
    ):
        used = whole.fact.groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
        part = (
            members.join(used, key, "left")
            .fillna(0, ["trips"])
            .select(
                F.lit(name).alias("dimension"), F.col(key).alias("code"),
                F.col(label).alias("label"), "trips",
            )
        )
        found = part if found is None else found.unionByName(part)
    return found


# --- star -----------------------------------------------------------------------------------


def fact_pit_join(spark: SparkSession, folder: str) -> DataFrame:
    side = shipped(spark, folder)
    lookup = star.location_lookup(side.locations)
    trips = side.valid.select(
        "trip_id", "load_month", "pickup_date", "pu_location_id", "do_location_id"
    )
    keyed = star.point_in_time(trips, lookup, "pu_location_id", "pickup_date", "pickup")
    keyed = star.point_in_time(keyed, lookup, "do_location_id", "pickup_date", "dropoff")
    versions = star.lookup_side(side.locations.select("location_key", "zone", "effective_from"))
    for role in ("pickup", "dropoff"):
        keyed = keyed.join(
            versions.select(
                F.col("location_key").alias(f"{role}_location_key"),
                F.col("zone").alias(f"{role}_zone"),
                F.col("effective_from").alias(f"{role}_version"),
            ),
            f"{role}_location_key",
        )
    return keyed.select(
        "trip_id", "load_month", "pickup_zone", "pickup_version", "dropoff_zone", "dropoff_version"
    )


def fact_pit_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The fact when the locations are too many to be broadcast: they meet by place and month."""
    side = shipped(spark, folder)
    return without_location_keys(star.located_fact(side.valid, side.locations, SHIPMENTS, limit=0))


def without_location_keys(fact: DataFrame) -> DataFrame:
    """Hashed keys as whether they are known, which plain SQL can tell as well."""
    unknown = star.unknown_location_key()
    for role in ("pickup", "dropoff"):
        key = F.col(f"{role}_location_key")
        fact = fact.withColumn(f"{role}_location_known", key != unknown).drop(f"{role}_location_key")
    return fact


def gold_fact(spark: SparkSession, folder: str) -> DataFrame:
    side = shipped(spark, folder)
    lookup = star.location_lookup(side.locations)
    return without_location_keys(star.build_fact(side.valid, lookup, SHIPMENTS))


def fk_resolve_static(spark: SparkSession, folder: str) -> DataFrame:
    return (
        shipped(spark, folder)
        .star.fact.groupBy("vendor_key", "rate_code_key", "payment_type_key")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def fk_resolve_scd(spark: SparkSession, folder: str) -> DataFrame:
    """Against a dimension that knows only two of three places: the rest is unknown, not lost."""
    side = shipped(spark, folder)
    some = side.locations.where("location_id = -1 OR location_id % 3 <> 1")
    fact = without_location_keys(
        star.build_fact(side.valid, star.location_lookup(some), SHIPMENTS)
    )
    return fact.groupBy("pickup_location_known", "dropoff_location_known").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast("decimal(20,2)").alias("receita")
    )


def star_join(spark: SparkSession, folder: str) -> DataFrame:
    """The fact with the labels of all its dimensions; one location dimension in two roles."""
    whole = evented(spark, folder).star
    places = star.lookup_side(whole.locations.select("location_key", "borough", "zone"))
    rows = whole.fact
    for role in ("pickup", "dropoff"):
        rows = rows.join(
            places.toDF(f"{role}_location_key", f"{role}_borough", f"{role}_zone"),
            f"{role}_location_key",
        )
    days = whole.dates.select(F.col("date_key").alias("pickup_date_key"), "year_month", "day_type")
    minutes = whole.clock.select(F.col("time_key").alias("pickup_time_key"), "time_label", "day_period")
    return (
        rows.join(star.lookup_side(days), "pickup_date_key")
        .join(star.lookup_side(minutes), "pickup_time_key")
        .join(F.broadcast(whole.vendors), "vendor_key")
        .join(F.broadcast(whole.rate_codes), "rate_code_key")
        .join(F.broadcast(whole.payment_types), "payment_type_key")
        .select(
            "trip_id", "year_month", "day_type", "time_label", "day_period", "pickup_borough",
            "pickup_zone", "dropoff_borough", "dropoff_zone", "vendor_name", "rate_code_name",
            "payment_type_name", "total_amount",
        )
    )


def orphan_check(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans of the fact when the location and payment dimensions lack some members."""
    whole = shipped(spark, folder).star
    lacking = star.Star(
        **{
            **whole.__dict__,
            "locations": whole.locations.where("location_id % 4 <> 2"),
            "payment_types": whole.payment_types.where("payment_type_key <> 3"),
        }
    )
    return star.orphans(lacking)


def dup_check(spark: SparkSession, folder: str) -> DataFrame:
    typed = add_trip_id(conform(raw_shipments(spark, folder), SHIPMENTS), SHIPMENTS.natural_key)
    before = star.repeated_ids(typed).withColumn("layer", F.lit("bronze"))
    after = star.repeated_ids(shipped(spark, folder).valid).withColumn("layer", F.lit("silver"))
    return before.unionByName(after)


def rowcount_match(spark: SparkSession, folder: str) -> DataFrame:
    side = shipped(spark, folder)
    return star.rowcount_gap(side.star.fact, side.valid)


# --- table mutation -------------------------------------------------------------------------

WRITTEN = ("trip_id", "order_key", "line_number", "trip_distance_mi", "total_amount", "load_month")


def replace_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Load all months; reload those of 1996 with fewer rows and one month with none at all."""
    table = f"{scratch_database(spark)}.trips"
    rows = shipped(spark, folder).valid.select(*WRITTEN)
    months = [r[0] for r in rows.select("load_month").distinct().collect()]
    tables.replace_partitions(rows, table, months)
    reloaded = [m for m in months if m.startswith("1996")]
    fewer = rows.where(F.col("load_month").isin(*reloaded) & (F.col("trip_distance_mi") < 20))
    for _ in range(2):
        tables.replace_partitions(fewer, table, [*reloaded, "1997-01"])
    return spark.table(table)


def full_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Write a table, then replace it by a computation over itself."""
    table = f"{scratch_database(spark)}.suppliers"
    tables.full_overwrite(read(spark, folder, "supplier"), table, "Suppliers")
    edited = spark.table(table).withColumn("s_acctbal", F.col("s_acctbal") + 1).where("s_nationkey <> 3")
    tables.full_overwrite(edited, table)
    return spark.table(table)


def append_history(spark: SparkSession, folder: str) -> DataFrame:
    table = f"{scratch_database(spark)}.customers"
    customers = read(spark, folder, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    tables.append(customers.where(building), table, ["c_mktsegment"])
    tables.append(customers.where(~building), table, ["c_mktsegment"])
    return spark.table(table)


def scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    table = f"{scratch_database(spark)}.suppliers"
    suppliers = read(spark, folder, "supplier")
    tables.upsert_scd1(suppliers, table, ["s_suppkey"])
    renamed = suppliers.where("s_suppkey % 3 = 0").withColumn("s_name", F.concat("s_name", F.lit(" v2")))
    new = suppliers.where("s_suppkey % 10 = 0").withColumn("s_suppkey", F.col("s_suppkey") + 10**9)
    tables.upsert_scd1(renamed.unionByName(new), table, ["s_suppkey"])
    return spark.table(table)


def second_customers(customers: DataFrame) -> DataFrame:
    """The customers one load later: some moved, some gone, some new."""
    key = F.col("c_custkey")
    moved = customers.where(key % 10 != 7).withColumn(
        "c_mktsegment",
        F.when(key % 4 == 0, F.lit("MOVED")).when(key % 4 == 1, F.lit(None)).otherwise(F.col("c_mktsegment")),
    )
    new = customers.where(key % 20 == 0).withColumn("c_custkey", key + 10**9)
    return moved.unionByName(new)


def scd2_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads, of which the third repeats the second and changes nothing."""
    table = f"{scratch_database(spark)}.customers"
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    later = second_customers(customers)
    for day, load in (("2024-01-01", customers), ("2024-02-01", later), ("2024-03-01", later)):
        tables.upsert_scd2(
            load, table, ["c_custkey"], ["c_nationkey", "c_mktsegment"], day, "customer_key"
        )
    return spark.table(table).drop("customer_key", "row_hash")


def third_customers(customers: DataFrame) -> DataFrame:
    """Two loads later: some are back where they were, some go elsewhere."""
    key = F.col("c_custkey")
    return customers.withColumn("c_mktsegment", F.when(key % 6 == 0, F.lit("THIRD")).otherwise(F.col("c_mktsegment")))


def scd2_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """The last load first, then the others, of which one comes twice: the history is that of the days."""
    table = f"{scratch_database(spark)}.customers"
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    first, second = ("2024-01-01", customers), ("2024-02-01", second_customers(customers))
    third = ("2024-03-01", third_customers(customers))
    for day, load in (third, first, second, first):
        histories.load_versions(load, table, ["c_custkey"], ["c_nationkey", "c_mktsegment"], day, "customer_key")
    return histories.read_versions(spark, table).drop("customer_key", "row_hash")


def scd2_changed(spark: SparkSession, folder: str) -> DataFrame:
    """The versions a second load closes and opens, without writing a table."""
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    key, tracked = ["c_custkey"], ["c_nationkey", "c_mktsegment"]
    first = history.scd2_merge(None, customers, key, tracked, "2024-01-01", "customer_key")
    merged = history.scd2_merge(
        first, second_customers(customers), key, tracked, "2024-02-01", "customer_key"
    )
    return merged.groupBy("effective_from", "effective_to", "is_current").agg(
        F.count(F.lit(1)).alias("versions")
    )


def schema_widening(spark: SparkSession, folder: str) -> DataFrame:
    """Years written one half after the other; the later half brings a column more."""
    table = f"{scratch_database(spark)}.orders"
    orders = read(spark, folder, "orders").withColumn("load_month", F.year("o_orderdate").cast("string"))
    for later, columns in ((False, []), (True, ["o_totalprice"])):
        part = orders.where((F.col("load_month") >= "1998") == F.lit(later)).select("o_orderkey", "o_custkey", *columns, "load_month")
        years = [r["load_month"] for r in part.select("load_month").distinct().collect()]  # as many rows as there are years
        tables.replace_partitions(part, table, years)
    return spark.table(table)


def scd2_untracked(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads with a column that is kept but opens no version."""
    table = f"{scratch_database(spark)}.customers"
    first = read(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    moved = F.when(F.col("c_custkey") % 3 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    later = first.withColumns({"c_mktsegment": moved, "c_acctbal": F.col("c_acctbal") + 1})
    for day, load in (("2024-01-01", first), ("2024-02-01", later)):
        tables.upsert_scd2(load, table, ["c_custkey"], ["c_mktsegment"], day, "customer_key")
    return spark.table(table).drop("customer_key", "row_hash")


def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    customers = read(spark, folder, "customer")
    return history.snapshot_diff(customers, second_customers(customers), ["c_custkey"])


def clustered_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Every month rewritten in the order of its locations and times, with the same rows."""
    table = f"{scratch_database(spark)}.trips"
    rows = shipped(spark, folder).valid.select(*WRITTEN, "pu_location_id", "pickup_datetime")
    months = [r[0] for r in rows.select("load_month").distinct().collect()]
    tables.replace_partitions(rows, table, months)
    tables.clustered_rewrite(spark, table, ["pu_location_id", "pickup_datetime"], months)
    return spark.table(table)


def clustered_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """For each column of a layout, whether its quarters are each found in under half of the files, by their bounds."""
    table = f"{scratch_database(spark)}.lines"
    columns = ["l_partkey", "l_suppkey"]
    rows = read(spark, folder, "lineitem").select("l_orderkey", *columns).withColumn("load_month", F.lit("all"))
    tables.replace_partitions(rows, table, ["all"])
    tables.clustered_rewrite(spark, table, columns, ["all"], files=64)
    bounds = spark.table(table).groupBy(F.input_file_name().alias("file")).agg(
        *[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    )
    quarters = rows.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75]).alias(c) for c in columns])
    sought = quarters.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("points")) for c in columns])).alias("s"))
    points = sought.select("s.name", F.explode("s.points").alias("point"))
    files = bounds.select("file", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("b")) for c in columns])).alias("f"))
    hit = F.col("point").between(F.col("b.low"), F.col("b.high"))
    read_files = files.select("file", "f.*").join(F.broadcast(points), "name").groupBy("name", "point").agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("files"))
    return read_files.groupBy("name").agg((F.max(F.col("hits") / F.col("files")) < 0.5).alias("skips"), F.max("files").alias("files"))


# --- quality --------------------------------------------------------------------------------


def checked_names(side: Layers) -> dict[str, DataFrame]:
    return {
        "table": side.star.fact,
        "orphans": stage(star.orphans(side.star), "orphans"),
        "gaps": stage(star.rowcount_gap(side.star.fact, side.valid), "gaps"),
    }


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Silver and gold expectations of the shipments, with some that are not met."""
    side = shipped(spark, folder)
    null_number = Expectation("nothing_observed", "SELECT CAST(NULL AS bigint) FROM {table} LIMIT 1", "== 0", "warn")
    silver = expectations.evaluate(
        spark, [*SHIPMENTS.expectations["silver.fct_source_trips"], null_number],
        "silver.fct_source_trips", "run", {"table": side.valid},
    )
    gold = expectations.evaluate(
        spark, SHIPMENTS.expectations["gold.fct_trips"], "gold.fct_trips", "run", checked_names(side)
    )
    return silver.unionByName(gold)


def dq_expectations(spark: SparkSession, folder: str) -> DataFrame:
    return results(spark, folder).drop("run_at", "run_id")


def dq_gate(spark: SparkSession, folder: str) -> DataFrame:
    """What a run recorded before a blocking expectation stopped it."""
    found = results(spark, folder)
    table = f"{scratch_database(spark)}.dq_results"
    rows = found.collect()  # as many as there are expectations
    tables.append(spark.createDataFrame(rows, found.schema), table)
    blocking = Expectation("nothing_shipped", "SELECT count(*) FROM {table}", "== 0")
    stopped = expectations.evaluate(spark, [blocking], "gold.fct_trips", "run", {"table": shipped(spark, folder).star.fact})
    tables.append(stopped, table)
    try:
        expectations.gate(spark.table(table).collect(), "gold.fct_trips")
        passed = True
    except expectations.ExpectationFailed:
        passed = False
    return spark.table(table).drop("run_at", "run_id").withColumn("run_passed", F.lit(passed))


def dq_on_write(spark: SparkSession, folder: str) -> DataFrame:
    """Expectations of the fact that the job that wrote it has counted; the table is not read for them."""
    table = f"{scratch_database(spark)}.fct_trips"
    fact = shipped(spark, folder).star.fact
    months = [r["load_month"] for r in fact.select("load_month").distinct().collect()]  # as many rows as there are months
    wanted = [e for e in SHIPMENTS.expectations["gold.fct_trips"] if e.predicate]
    predicates = {e.name: e.predicate for e in wanted}
    load = tables.load_partitions(fact, table, months, counting=predicates)
    measured.keep(spark, f"{table}_measured", "gold.fct_trips", load, predicates)
    held = measured.counts(spark, f"{table}_measured", "gold.fct_trips", table, months, list(predicates.values()))
    counted = {name: held[predicate] for name, predicate in predicates.items()}
    return expectations.evaluate(spark, wanted, "gold.fct_trips", "run", {}, counted).drop("run_at", "run_id")


def bronze_file(spark: SparkSession, folder: str) -> DataFrame:
    """All events as month files, read by service and month from the names of the files."""
    root = fresh_folder(spark, "landing")
    events = read(spark, folder, "events")
    months = months_of(events, "ts")
    for month in months:
        part = events.where(F.date_format("ts", "yyyy-MM") == month)
        part.write.parquet(landing.month_file(root, "green", month))
    whole = reduce(DataFrame.unionByName, [landing.read_month(spark, root, "green", month, "batch") for month in months])
    named = F.regexp_extract("_source_file", r"/([a-z]+_tripdata_[0-9-]+\.parquet)/", 1)
    return whole.select("event_id", "value", "load_month", "_batch_id", named.alias("file_name"))


def dq_table(spark: SparkSession, folder: str) -> DataFrame:
    """A results table after two runs."""
    table = f"{scratch_database(spark)}.dq_results"
    found = results(spark, folder)
    for run_id in ("first", "second"):
        tables.append(found.withColumn("run_id", F.lit(run_id)), table)
    return spark.table(table)


def a7_dq_history(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.latest(dq_table(spark, folder)).drop("run_at")


def dq_failures(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.failures(dq_table(spark, folder)).drop("run_at")


# --- layers, increments -----------------------------------------------------------------------

_RUNS: dict[tuple[str, str], Lakehouse] = {}


def lakehouse(spark: SparkSession, folder: str) -> Lakehouse:
    """The events taken through all layers into tables, once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _RUNS:
        names = {layer: f"{layer}_{uuid.uuid4().hex[:8]}" for layer in ("bronze", "silver", "gold")}
        root = fresh_folder(spark, "lake")
        for name in names.values():
            spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{name}'")
        zones = f"{root}/zones"
        (
            raw_places(spark, folder)
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(zones)
        )
        source = f"{names['bronze']}.source_events"
        source_events(spark, folder).write.saveAsTable(source)
        lake = Lakehouse(
            domain=EVENTS, landing=root, zones=zones, raw_root=f"{root}/raw_trips",
            schemas=names, source_table=source, source_moment="Started",
            clustering={
                "silver.fct_source_trips": ("pu_location_id", "pickup_datetime"),
                "gold.fct_trips": ("pickup_date_key", "pickup_location_key"),
            },
        )
        run_layers(spark, lake, months_of(spark.table(source), "Started"))
        _RUNS[key] = lake
    return _RUNS[key]


def run_all_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table after a run of all layers."""
    lake = lakehouse(spark, folder)
    named = {"raw_trips": landing.lineage_of(spark, lake.raw_root)}
    for layer, names in {
        "bronze": ["raw_taxi_zones"],
        "silver": ["fct_source_trips", "fct_source_trips_quarantine", "dim_source_zones"],
        "gold": [
            "dim_date", "dim_time", "dim_vendor", "dim_rate_code", "dim_payment_type",
            "dim_location", "fct_trips", "dq_results",
        ],
    }.items():
        named.update({name: spark.table(lake.table(layer, name)) for name in names})
    counted = None
    for name, table in named.items():
        row = table.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        counted = row if counted is None else counted.unionByName(row)
    return counted


def bronze_layer(spark: SparkSession, folder: str) -> DataFrame:
    lake = lakehouse(spark, folder)
    return landing.lineage_of(spark, lake.raw_root).groupBy("load_month").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("_batch_id").alias("lotes")
    )


def silver_layer(spark: SparkSession, folder: str) -> DataFrame:
    lake = lakehouse(spark, folder)
    shown = ["event_id", "trip_id", "total_amount", "trip_duration_min", "trip_distance_km", "load_month"]
    valid = spark.table(lake.valid).select(*shown, F.lit("").alias("violations"))
    rejected = spark.table(lake.quarantine).select(
        *shown, F.array_join("_violations", ",").alias("violations")
    )
    return valid.unionByName(rejected)


def gold_layer(spark: SparkSession, folder: str) -> DataFrame:
    return without_location_keys(spark.table(lakehouse(spark, folder).fact))


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two files land one after the other; a third run finds nothing new."""
    root = fresh_folder(spark, "stream")
    events = read(spark, folder, "events")

    def take() -> None:
        ingest_new_files(
            spark, f"{root}/landing/*", events.schema, f"{root}/raw", f"{root}/checkpoint"
        ).awaitTermination()

    for month, half in (("2024-01", F.col("event_id") % 2 == 0), ("2024-02", F.col("event_id") % 2 == 1)):
        events.where(half).write.parquet(f"{root}/landing/events_tripdata_{month}.parquet")
        take()
    take()
    return spark.read.parquet(f"{root}/raw").select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("load_month").cast("string").alias("load_month")
    )


def month_file(root: str, month: str) -> str:
    return f"{root}/landing/events_tripdata_{month}.parquet"


def incremental_reland(spark: SparkSession, folder: str) -> DataFrame:
    """Two months land; then one lands again with other values, and a file with a new column joins the other."""
    root = fresh_folder(spark, "reland")
    events = read(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    first, second = events.where("event_id % 3 = 0"), events.where("event_id % 3 = 1")
    for month, part in (("2024-01", first), ("2024-02", second)):
        part.write.parquet(month_file(root, month))
    ingest_landed(spark, f"{root}/landing", f"{root}/raw")
    first.withColumn("value", F.col("value") * 2).write.mode("overwrite").parquet(month_file(root, "2024-01"))
    added = events.where("event_id % 3 = 2").withColumn("fee", F.col("value") / 4)
    added.write.mode("append").parquet(month_file(root, "2024-02"))
    months = ingest_landed(spark, f"{root}/landing", f"{root}/raw")
    ingest_landed(spark, f"{root}/landing", f"{root}/raw")
    view = f"{scratch_database(spark)}.raw_events"
    landing.publish_raw(spark, view, f"{root}/raw", recorded_schemas(spark, f"{root}/raw", months))
    return spark.sql(f"SELECT event_id, ts, event_type, value, fee, load_month FROM {view}")


def bronze_table(spark: SparkSession, folder: str) -> DataFrame:
    """The raw months of the run of all layers, as one relation for plain SQL."""
    view = lakehouse(spark, folder).table("bronze", "raw_trips")
    return spark.sql(
        f"""SELECT load_month, store_and_fwd_flag AS flag, count(*) AS trips, CAST(sum(Fare) AS DECIMAL(20,2)) AS fares
        FROM {view} GROUP BY load_month, store_and_fwd_flag"""
    )


def incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """Events land with flaws and are taken to the fact; they land again as they are, and only changes follow."""
    root = fresh_folder(spark, "increments")
    names = {layer: f"{layer}_{uuid.uuid4().hex[:8]}" for layer in ("bronze", "silver", "gold")}
    for name in names.values():
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{name}'")
    raw_places(spark, folder).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{root}/zones")
    events = stage(source_events(spark, folder), "events")
    lake = Lakehouse(
        domain=EVENTS, landing=f"{root}/landing", zones=f"{root}/zones", raw_root=f"{root}/raw", schemas=names, streamed=True
    )
    id_ = F.col("event_id")
    doubled = F.when(id_ % 5 == 0, F.col("Total") * 2).otherwise(F.col("Total")).cast("decimal(14,4)")
    flawed = events.where(id_ % 7 != 0).withColumn("Total", doubled)
    for version in (flawed, events):
        for month in months_of(events, "Started"):
            version.where(F.date_format("Started", "yyyy-MM") == month).write.mode("overwrite").parquet(month_file(root, month))
        run_increment(spark, lake, skip_quality=True)
    return without_location_keys(spark.table(lake.fact))


def incremental_fact(spark: SparkSession, folder: str) -> DataFrame:
    """A fact built from an older silver, brought up to date by the changed rows alone."""
    side = shipped(spark, folder)
    lookup = star.location_lookup(side.locations)
    older = side.valid.where("line_number <> 2").withColumn(
        "tip_amount",
        F.when(F.col("line_number") == 3, F.lit(0).cast("decimal(10,2)")).otherwise(F.col("tip_amount")),
    )
    removed = side.valid.where("line_number = 4").withColumn("trip_id", F.concat(F.lit("gone-"), "trip_id"))
    older = older.unionByName(removed)
    changes = history.snapshot_diff(older, side.valid, ["load_month", "trip_id"])
    updated = refreshed_fact(
        star.build_fact(older, lookup, SHIPMENTS), changes, side.valid, lookup, SHIPMENTS
    )
    return without_location_keys(updated)


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    side = shipped(spark, folder)
    return marts.layer_counts(side.raw, side.valid, side.quarantine, side.star.fact)


def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    side = evented(spark, folder)
    return marts.summary(side.raw, side.quarantine, side.star.fact)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """From raw events to revenue by period and borough in one plan, around a written dimension."""
    valid = rules.accepted(tagged_trips(raw_events(spark, folder), EVENTS))
    places = stage(
        two_version_locations(spark, folder, CHANGE_DAY["events"], EVENTS.airport_pattern), "places"
    )
    fact = star.build_fact(valid, star.location_lookup(places), EVENTS)
    codes = dimensions.code_dimension
    whole = star.Star(
        fact=fact,
        dates=dimensions.calendar(dimensions.calendar_bounds(valid)),
        clock=dimensions.clock(spark),
        locations=places,
        vendors=codes(spark, EVENTS.vendors),
        rate_codes=codes(spark, EVENTS.rate_codes),
        payment_types=codes(spark, EVENTS.payment_types),
    )
    return marts.period_by_borough(whole)


def over_star(mart: Callable[[star.Star], DataFrame], name: str) -> Query:
    return lambda spark, folder: mart(layers(spark, folder, name).star)


QUERIES: dict[str, Query] = {
    # sources and scans
    "bronze_ingest": bronze_ingest,
    "bronze_csv_lookup": bronze_csv_lookup,
    "table_source": table_source,
    "months_scan": months_scan,
    "bronze_lineage": bronze_lineage,
    # conforming
    "silver_normalize": silver_normalize,
    "silver_cast": silver_cast,
    "silver_derive": silver_derive,
    "silver_zones": silver_zones,
    "silver_flow": silver_flow,
    # keys, copies, rules
    "trip_id": trip_id,
    "dedup_latest": dedup_latest,
    "rule_violations": rule_violations,
    "split_valid": split_valid,
    "split_quarantine": split_quarantine,
    "reconcile_layers": reconcile_layers,
    "schema_widening": schema_widening,
    "dq_gate": dq_gate,
    "bronze_file": bronze_file,
    "scd2_untracked": scd2_untracked,
    "quarantine_reasons": quarantine_reasons,
    "quarantine_sample": quarantine_sample,
    # dimensions
    "dim_date": dim_date,
    "dim_time": dim_time,
    "dim_static": dim_static,
    "dim_location": dim_location,
    "calendar_bounds": calendar_bounds,
    # star
    "fact_pit_join": fact_pit_join,
    "fact_pit_by_month": fact_pit_by_month,
    "gold_fact": gold_fact,
    "fk_resolve_static": fk_resolve_static,
    "fk_resolve_scd": fk_resolve_scd,
    "star_join": star_join,
    "orphan_check": orphan_check,
    "dup_check": dup_check,
    "rowcount_match": rowcount_match,
    # writers and table mutation
    "replace_partitions": replace_partitions,
    "full_overwrite": full_overwrite,
    "append_history": append_history,
    "scd1_upsert": scd1_upsert,
    "scd2_upsert": scd2_upsert,
    "scd2_changed": scd2_changed,
    "snapshot_diff": snapshot_diff,
    "clustered_rewrite": clustered_rewrite,
    "clustered_skipping": clustered_skipping,
    "scd2_backfill": scd2_backfill,
    # quality
    "dq_expectations": dq_expectations,
    "dq_failures": dq_failures,
    "dq_on_write": dq_on_write,
    "a7_dq_history": a7_dq_history,
    # marts
    "a1_revenue_month_payment": over_star(marts.revenue_by_month_and_payment, "shipments"),
    "a2_top_flows": over_star(lambda s: marts.top_flows(s, more_than=5), "shipments"),
    "a3_speed_by_hour": over_star(marts.speed_by_hour, "events"),
    "a4_airport_vs_city": over_star(marts.airport_versus_city, "shipments"),
    "a5_weekday_period": over_star(marts.weekday_by_period, "events"),
    "a6_quarantine_rate": lambda spark, folder: marts.quarantine_rate(
        shipped(spark, folder).valid, shipped(spark, folder).quarantine
    ),
    "a9_period_borough": flagship,
    "a9_period_borough_top": over_star(marts.top_period_by_borough, "events"),
    "kpi_summary": kpi_summary,
    "kpi_trips_by_hour": over_star(marts.trips_by_hour, "events"),
    "kpi_revenue_by_period": over_star(marts.revenue_by_period, "events"),
    "kpi_revenue_by_borough": over_star(marts.revenue_by_borough, "events"),
    "layer_counts": layer_counts,
    # whole layers and increments
    "bronze_layer": bronze_layer,
    "silver_layer": silver_layer,
    "gold_layer": gold_layer,
    "run_layers": run_all_layers,
    "incremental_ingest": incremental_ingest,
    "incremental_fact": incremental_fact,
    "incremental_reland": incremental_reland,
    "incremental_run": incremental_run,
    "bronze_table": bronze_table,
}
