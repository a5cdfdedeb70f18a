"""Order lines as trips: from the supplier's nation to the customer's, ordered and then shipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (
    LINEAGE_FIELDS,
    Codes,
    Domain,
    Expectation,
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

FIELDS = (
    long("order_key", "orderkey"),
    long("line_number", "linenumber"),
    long("part_key", "partkey"),
    long("supplier_key", "suppkey"),
    money("list_amount", "listprice"),
    whole("vendor_id", "vendorid"),
    moment("pickup_datetime", "orderdate"),
    moment("dropoff_datetime", "shipdate"),
    whole("passenger_count", "passengers"),
    real("trip_distance_mi", "quantity"),
    whole("rate_code_id", "ratecode"),
    text("store_and_fwd_flag", "returnflag"),
    whole("pu_location_id", "origin"),
    whole("do_location_id", "destination"),
    whole("payment_type_id", "priority"),
    money("fare_amount", "fare"),
    money("extra_amount", "extra"),
    money("mta_tax_amount", "tax"),
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
    Rule("duration_within_bounds", "trip_duration_min BETWEEN 1440 AND 525600"),
    Rule("distance_positive", "trip_distance_mi > 0 AND trip_distance_mi < 45"),
    Rule("fare_non_negative", "fare_amount >= 0 AND total_amount >= 0"),
    Rule("passenger_count_plausible", "passenger_count IS NULL OR passenger_count BETWEEN 0 AND 9"),
    Rule("pickup_within_declared_month", "date_format(pickup_datetime, 'yyyy-MM') = load_month"),
    Rule(
        "location_ids_valid", "pu_location_id BETWEEN 0 AND 24 AND do_location_id BETWEEN 0 AND 24"
    ),
)

VENDORS = Codes(
    "vendor_key",
    "vendor_key int, vendor_name string",
    tuple((code, f"Carrier {code}") for code in range(7)),
    (-1, "Nao informado"),
)
RATE_CODES = Codes(
    "rate_code_key",
    "rate_code_key int, rate_code_name string, is_standard boolean",
    tuple((code, f"Line {code}", code == 1) for code in range(1, 7)),
    (-1, "Nao informado", False),
)
PAYMENT_TYPES = Codes(
    "payment_type_key",
    "payment_type_key int, payment_type_name string, is_electronic boolean",
    ((1, "Urgent", True), (2, "High", True), (3, "Medium", False), (4, "Not specified", False)),
    (-1, "Nao informado", False),
)

SHIPMENTS = Domain(
    fields=FIELDS,
    natural_key=("order_key", "line_number"),
    rules=RULES,
    vendors=VENDORS,
    rate_codes=RATE_CODES,
    payment_types=PAYMENT_TYPES,
    airport_pattern="(?i)nation_(3|13|23)$",
    tie_break=("part_key", "supplier_key", "trip_distance_mi", "list_amount"),
    expectations={
        **EXPECTATIONS,
        "gold.fct_trips": (
            *EXPECTATIONS["gold.fct_trips"],
            Expectation.of_rows("few_generous_tips", "tip_pct > 0.1", "<= 0", severity="warn"),
        ),
    },
)


def raw_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """The joined source tables, in the spellings of a source file.

    Orders meet their customer before the four times larger lines do. Lines and orders both grow
    with the data, so neither is to be broadcast on the strength of an estimate; the other joins
    are left to Spark's size statistics. Lines and orders are dealt by order among as many tasks as the lines ask
    for, which leaves copies of a line together: silver then seeks them without a further exchange.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders").join(
        table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    lines = table("lineitem").withColumn("_source_file", F.col("_metadata.file_name"))
    rows = table("lineitem").count()  # from the footers
    joined = dealt(lines, rows, "l_orderkey").join(
        dealt(
            orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "c_nationkey"), rows, "l_orderkey"
        ).hint("merge"),
        "l_orderkey",
    ).join(table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    fare = price * (F.lit(1) - discount)
    tax = fare * F.col("l_tax").cast("decimal(4,2)")
    return joined.select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_partkey").alias("PartKey"),
        F.col("l_suppkey").alias("SuppKey"),
        price.alias("ListPrice"),
        (F.col("l_suppkey") % 9).alias("VendorID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("l_shipdate").alias("ShipDate"),
        (F.col("l_partkey") % 11).alias("Passengers"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_linenumber").alias("RateCode"),
        F.col("l_returnflag").alias("ReturnFlag"),
        F.col("s_nationkey").alias("Origin"),
        F.col("c_nationkey").alias("Destination"),
        F.substring("o_orderpriority", 1, 1).alias("Priority"),
        fare.alias("Fare"),
        tax.alias("Tax"),
        (price * discount).alias("Tip"),
        (fare + tax).alias("Total"),
        F.when(F.col("l_returnflag") == "R", F.lit(1.75)).alias("Airport_fee"),
        F.date_format("o_orderdate", "yyyy-MM").alias("load_month"),
        F.col("l_shipdate").alias("_ingested_at"),
        "_source_file",
        F.lit("shipments").alias("_batch_id"),
    )


def raw_places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations and their regions in the shape of the location lookup."""
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    zone_kind = (
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("Yellow Zone"))
        .when(F.col("n_nationkey") % 3 == 1, F.lit(" Boro Zone "))
    )
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        zone_kind.alias("service_zone"),
    )
