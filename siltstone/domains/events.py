"""User events as trips that start at the event and last as many minutes as its value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (
    LINEAGE_FIELDS,
    Codes,
    Domain,
    Rule,
    long,
    moment,
    money,
    real,
    text,
    whole,
)
from ..operators.identity import dealt
from .trips import EXPECTATIONS

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

FIELDS = (
    long("event_id"),
    whole("vendor_id", "vendorid"),
    moment("pickup_datetime", "started"),
    moment("dropoff_datetime", "ended"),
    whole("passenger_count", "passengers"),
    real("trip_distance_mi", "distance"),
    whole("rate_code_id", "ratecode"),
    text("store_and_fwd_flag"),
    whole("pu_location_id", "origin"),
    whole("do_location_id", "destination"),
    whole("payment_type_id", "payment_type"),
    money("fare_amount", "fare"),
    money("extra_amount", "extra"),
    money("mta_tax_amount", "mta_tax"),
    money("tip_amount", "tip"),
    money("tolls_amount", "tolls"),
    money("improvement_surcharge_amount", "improvement_surcharge"),
    money("total_amount", "total"),
    money("congestion_surcharge_amount", "congestion_surcharge"),
    money("airport_fee_amount", "airport_fee"),
    money("cbd_congestion_fee_amount", "cbd_congestion_fee"),
    *LINEAGE_FIELDS,
)

RULES = (
    Rule("pickup_not_null", "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"),
    Rule("chronological_order", "dropoff_datetime > pickup_datetime"),
    Rule("duration_within_bounds", "trip_duration_min BETWEEN 1 AND 360"),
    Rule("distance_positive", "trip_distance_mi > 0 AND trip_distance_mi < 200"),
    Rule("fare_non_negative", "fare_amount >= 0 AND total_amount >= 0"),
    Rule("passenger_count_plausible", "passenger_count IS NULL OR passenger_count BETWEEN 0 AND 9"),
    Rule("pickup_within_declared_month", "date_format(pickup_datetime, 'yyyy-MM') = load_month"),
    Rule(
        "location_ids_valid", "pu_location_id BETWEEN 0 AND 24 AND do_location_id BETWEEN 0 AND 24"
    ),
)

# The last event type is left out, so that it becomes the unknown member.
PAYMENT_TYPES = Codes(
    "payment_type_key",
    "payment_type_key int, payment_type_name string, is_electronic boolean",
    tuple((at, name, name == "purchase") for at, name in enumerate(EVENT_TYPES[:-1], start=1)),
    (-1, "Nao informado", False),
)
VENDORS = Codes(
    "vendor_key",
    "vendor_key int, vendor_name string",
    tuple((code, f"Channel {code}") for code in range(8)),
    (-1, "Nao informado"),
)
RATE_CODES = Codes(
    "rate_code_key",
    "rate_code_key int, rate_code_name string, is_standard boolean",
    tuple((code, f"Plan {code}", code == 1) for code in range(1, 7)),
    (-1, "Nao informado", False),
)

EVENTS = Domain(
    fields=FIELDS,
    natural_key=("event_id",),
    rules=RULES,
    vendors=VENDORS,
    rate_codes=RATE_CODES,
    payment_types=PAYMENT_TYPES,
    airport_pattern="(?i)nation_(3|13|23)$",
    expectations=EXPECTATIONS,
)


def source_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their user's nation, in the spellings of a source file."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    users = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey"
    )
    k = F.get_json_object("props", "$.k").cast("int")
    fare = F.col("value").cast("decimal(10,2)")
    tip = fare * (k % 30).cast("decimal(4,0)") / F.lit(100).cast("decimal(3,0)")
    seconds = F.round(F.col("value") * 60).cast("int")
    payment = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("event_type"))
    return events.join(users, "user_id", "left").select(
        "event_id",
        (F.col("user_id") % 9).alias("VendorID"),
        F.col("ts").alias("Started"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("Ended"),
        (k % 11).alias("Passengers"),
        k.alias("Distance"),
        (F.col("event_id") % 8).alias("RateCode"),
        F.when(F.col("event_type") == "error", F.lit("Y")).otherwise(F.lit("N")).alias(
            "store_and_fwd_flag"
        ),
        F.col("c_nationkey").alias("Origin"),
        (k % 25).alias("Destination"),
        payment.alias("payment_type"),
        fare.alias("Fare"),
        tip.alias("Tip"),
        (fare + tip).alias("Total"),
        F.when(F.col("event_type") == "signup", F.lit(1.75)).alias("Airport_fee"),
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Source events with their load columns, fixed so that results can be compared.

    They are dealt by id among as many tasks as their number asks for, so that silver seeks copies without a further exchange.
    """
    rows = spark.read.parquet(f"{folder}/events.parquet").count()  # from the footers
    return dealt(source_events(spark, folder), rows, "event_id").withColumns(
        {
            "load_month": F.date_format("Started", "yyyy-MM"),
            "_ingested_at": F.col("Started"),
            "_source_file": F.lit("events.parquet"),
            "_batch_id": F.lit("events"),
        }
    )
