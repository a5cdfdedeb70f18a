"""Trips: monthly Parquet files and a CSV of zones."""

from __future__ import annotations

from ..contracts import (
    LINEAGE_FIELDS,
    Codes,
    Domain,
    Expectation,
    Rule,
    moment,
    money,
    real,
    text,
    whole,
)

# Source spellings of each conformed column (two services share one contract).
FIELDS = (
    whole("vendor_id", "vendorid"),
    moment("pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime"),
    moment("dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime"),
    whole("passenger_count"),
    real("trip_distance_mi", "trip_distance"),
    whole("rate_code_id", "ratecodeid"),
    text("store_and_fwd_flag"),
    whole("pu_location_id", "pulocationid"),
    whole("do_location_id", "dolocationid"),
    whole("payment_type_id", "payment_type"),
    money("fare_amount"),
    money("extra_amount", "extra"),
    money("mta_tax_amount", "mta_tax"),
    money("tip_amount"),
    money("tolls_amount"),
    money("improvement_surcharge_amount", "improvement_surcharge"),
    money("total_amount"),
    money("congestion_surcharge_amount", "congestion_surcharge"),
    money("airport_fee_amount", "airport_fee"),
    money("cbd_congestion_fee_amount", "cbd_congestion_fee"),
    *LINEAGE_FIELDS,
)

# The columns that make the id of a trip.
NATURAL_KEY = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "trip_distance_mi",
    "total_amount",
)

# Rule names and bounds.
RULES = (
    Rule("pickup_not_null", "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"),
    Rule("chronological_order", "dropoff_datetime > pickup_datetime"),
    Rule("duration_within_bounds", "trip_duration_min BETWEEN 1 AND 360"),
    Rule("distance_positive", "trip_distance_mi > 0 AND trip_distance_mi < 200"),
    Rule("fare_non_negative", "fare_amount >= 0 AND total_amount >= 0"),
    Rule("passenger_count_plausible", "passenger_count IS NULL OR passenger_count BETWEEN 0 AND 9"),
    Rule("pickup_within_declared_month", "date_format(pickup_datetime, 'yyyy-MM') = load_month"),
    Rule(
        "location_ids_valid",
        "pu_location_id BETWEEN 1 AND 265 AND do_location_id BETWEEN 1 AND 265",
    ),
)

# Published code lists and their labels.
VENDORS = Codes(
    "vendor_key",
    "vendor_key int, vendor_name string",
    (
        (1, "Creative Mobile Technologies"),
        (2, "Curb Mobility"),
        (6, "Myle Technologies"),
        (7, "Helix"),
    ),
    (-1, "Nao informado"),
)
RATE_CODES = Codes(
    "rate_code_key",
    "rate_code_key int, rate_code_name string, is_standard boolean",
    (
        (1, "Tarifa padrao", True),
        (2, "JFK", False),
        (3, "Newark", False),
        (4, "Nassau ou Westchester", False),
        (5, "Tarifa negociada", False),
        (6, "Corrida em grupo", False),
        (99, "Nao identificada", False),
    ),
    (-1, "Nao informado", False),
)
PAYMENT_TYPES = Codes(
    "payment_type_key",
    "payment_type_key int, payment_type_name string, is_electronic boolean",
    (
        (0, "Flex Fare", False),
        (1, "Cartao de credito", True),
        (2, "Dinheiro", False),
        (3, "Sem cobranca", False),
        (4, "Contestada", False),
        (5, "Desconhecida", False),
        (6, "Anulada", False),
    ),
    (-1, "Nao informado", False),
)
# Fixed value: names by which a zone is an airport.
AIRPORT_PATTERN = "(?i)(JFK|LaGuardia|Newark|Airport)"

# Names and bounds of the expectations. ``{table}`` is the checked table restricted to the months of the run; ``{orphans}`` and ``{gaps}``
# are the results of the operators of those names over the same months.
EXPECTATIONS = {
    "silver.fct_source_trips": (
        Expectation(
            "no_duplicate_trip_ids",
            """SELECT count(*) FROM (
                 SELECT trip_id FROM {table} GROUP BY trip_id HAVING count(*) > 1) repeated""",
            "== 0",
        ),
        Expectation.of_rows("surrogate_keys_not_null", "trip_id IS NULL", "== 0"),
    ),
    "gold.fct_trips": (
        Expectation(
            "no_orphan_location_keys",
            """SELECT coalesce(sum(observed), 0) FROM {orphans}
               WHERE foreign_key IN ('pickup_location_key', 'dropoff_location_key')""",
            "== 0",
        ),
        Expectation(
            "no_orphan_keys",
            "SELECT coalesce(sum(observed), 0) FROM {orphans}",
            "== 0",
        ),
        Expectation.of_rows("tip_ratio_within_bounds", "tip_pct > 1.0", "== 0", severity="warn"),
        Expectation(
            "fact_matches_silver_rowcount",
            "SELECT coalesce(sum(observed), 0) FROM {gaps}",
            "== 0",
        ),
    ),
}

TRIPS = Domain(
    fields=FIELDS,
    natural_key=NATURAL_KEY,
    rules=RULES,
    vendors=VENDORS,
    rate_codes=RATE_CODES,
    payment_types=PAYMENT_TYPES,
    airport_pattern=AIRPORT_PATTERN,
    expectations=EXPECTATIONS,
)
