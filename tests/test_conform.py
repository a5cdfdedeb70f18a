from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone.domains.trips import FIELDS, NATURAL_KEY, RULES, TRIPS
from siltstone.operators.conform import cast, normalize
from siltstone.operators.dimensions import conform_zones
from siltstone.operators.identity import add_trip_id, keep_latest
from siltstone.operators.metrics import derive
from siltstone.operators.rules import (
    accepted,
    quarantine_reasons,
    quarantine_sample,
    quarantined,
    reconcile,
    split,
    tag,
)
from siltstone.plans.silver import build_trips, conform, prepare


def test_normalize_renames_and_adds_what_is_missing(raw_trips):
    out = normalize(raw_trips, FIELDS)
    assert out.columns == [f.name for f in FIELDS]
    assert out.where("cbd_congestion_fee_amount IS NOT NULL").count() == 0
    assert dict(out.dtypes)["cbd_congestion_fee_amount"] == "decimal(10,2)"


def test_normalize_ignores_case_drops_unknown_and_takes_the_first(spark):
    df = spark.createDataFrame([(1, 2.5, 9.5, "x")], "VENDORID int, Airport_fee double, b double, odd string")
    twice = df.toDF("VENDORID", "Airport_fee", "airport_fee", "odd")
    out = normalize(twice, FIELDS)
    assert out.select("vendor_id", "airport_fee_amount").first()[:] == (1, 2.5)
    assert "odd" not in out.columns


def test_both_services_share_one_contract(spark):
    green = spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS lpep_pickup_datetime")
    assert conform(green, TRIPS).first()["pickup_datetime"] == datetime(2024, 1, 1, 10)


def test_cast_turns_bad_values_into_null_and_missing_money_into_zero(spark):
    raw = spark.sql(
        "SELECT 'seven' AS VendorID, '2' AS passenger_count, 'x' AS fare_amount, "
        "CAST(1e12 AS double) AS tip_amount, timestamp_ntz'2024-01-01 10:00:00' AS tpep_pickup_datetime"
    )
    row = cast(normalize(raw, FIELDS), FIELDS).first()
    assert row["vendor_id"] is None and row["passenger_count"] == 2
    assert str(row["fare_amount"]) == "0.00" and str(row["tip_amount"]) == "0.00"
    assert str(row["cbd_congestion_fee_amount"]) == "0.00"
    assert row["pickup_datetime"] == datetime(2024, 1, 1, 10)


def test_derived_columns(raw_trips):
    row = derive(conform(raw_trips, TRIPS)).where("vendor_id = 6").first()
    assert row["trip_duration_min"] == 80.0
    assert row["trip_distance_km"] == pytest.approx(24.945)
    assert row["avg_speed_kmh"] == pytest.approx(18.71)
    assert row["tip_pct"] == pytest.approx(0.25)
    assert row["pickup_hour"] == 6 and row["is_airport_trip"] is True


def test_speed_is_null_without_duration_and_tip_is_zero_without_fare(spark):
    raw = spark.sql(
        "SELECT timestamp'2024-01-01 10:00:00' AS tpep_pickup_datetime, "
        "timestamp'2024-01-01 10:00:00' AS tpep_dropoff_datetime, 1.0 AS trip_distance, 3.0 AS tip_amount"
    )
    row = derive(conform(raw, TRIPS)).first()
    assert row["avg_speed_kmh"] is None and row["tip_pct"] == 0.0


def test_same_trip_same_id(raw_trips):
    ids = add_trip_id(conform(raw_trips, TRIPS), NATURAL_KEY)
    assert ids.count() == 12 and ids.select("trip_id").distinct().count() == 11
    assert ids.where("length(trip_id) <> 64").count() == 0


def test_id_needs_utc(spark, raw_trips):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            add_trip_id(raw_trips, ["VendorID"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_copies_are_removed(raw_trips):
    assert prepare(raw_trips, TRIPS).count() == 11


def test_last_ingested_copy_wins_and_ties_do_not_depend_on_partitioning(spark):
    rows = [("a", "m", t, v) for t in (1, 2) for v in (5, 3, 9)] + [("b", "m", 1, 1)]
    df = spark.createDataFrame(rows, "trip_id string, load_month string, _ingested_at int, v int")
    for n in (1, 3, 7):
        kept = keep_latest(df.repartition(n)).orderBy("trip_id").collect()
        assert [(r["trip_id"], r["_ingested_at"], r["v"]) for r in kept] == [("a", 2, 3), ("b", 1, 1)]


def test_copies_of_a_hot_id_shrink_before_the_exchange(spark):
    df = spark.range(1000).selectExpr(
        "string(id % 2) AS trip_id", "string(id % 3) AS load_month", "id AS _ingested_at", "id AS v"
    )
    plan = keep_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("Final") < plan.index("Exchange") < plan.rindex("Partial")


def test_a_copy_in_another_month_is_judged_there(raw_trips):
    """Running two months together gives the same tables as running them apart."""
    later = raw_trips.withColumn("load_month", F.lit("2024-02"))
    together = build_trips(raw_trips.unionByName(later), TRIPS)
    apart = [build_trips(raw_trips, TRIPS), build_trips(later, TRIPS)]
    for at in (0, 1):
        keys = ["trip_id", "load_month"]
        one = {tuple(r) for r in together[at].select(*keys).collect()}
        two = {tuple(r) for side in apart for r in side[at].select(*keys).collect()}
        assert one == two


def test_quarantine_keeps_the_reasons(raw_trips):
    valid, invalid = build_trips(raw_trips, TRIPS)
    assert valid.count() == 6 and invalid.count() == 5
    assert "_violations" not in valid.columns and "_quarantined_at" in invalid.columns
    reasons = {r["motivo"]: r["linhas"] for r in quarantine_reasons(invalid).collect()}
    assert reasons == {
        "chronological_order": 1,
        "duration_within_bounds": 2,
        "distance_positive": 1,
        "passenger_count_plausible": 1,
        "pickup_within_declared_month": 1,
    }
    assert quarantine_sample(invalid, "distance_positive").count() == 1


def test_a_null_rule_is_a_broken_rule(spark):
    df = spark.sql("SELECT CAST(NULL AS timestamp) AS pickup_datetime, 1 AS n")
    from siltstone.contracts import Rule

    rules = [Rule("late", "pickup_datetime > timestamp'2024-01-01'"), Rule("n", "n = 1")]
    valid, invalid = split(df, rules)
    assert valid.count() == 0 and invalid.first()["_violations"] == ["late"]


def test_no_rules_accept_everything(spark):
    assert accepted(tag(spark.range(3), ())).count() == 3


def test_rule_names_are_unique():
    assert len({r.name for r in RULES}) == len(RULES) == 8


def test_every_row_is_accounted_for(raw_trips):
    tagged = tag(prepare(raw_trips, TRIPS), RULES)
    raw = add_trip_id(conform(raw_trips, TRIPS), NATURAL_KEY)

    def settled(valid, invalid):
        row = reconcile(raw, valid, invalid).first()
        return tuple(row[c] for c in ("ingeridas", "aceitas", "rejeitadas", "duplicadas", "diferenca"))

    assert settled(accepted(tagged), quarantined(tagged)) == (12, 6, 5, 1, 0)
    lost = accepted(tagged).where("vendor_id IS NULL OR vendor_id <> 6")
    assert settled(lost, quarantined(tagged)) == (12, 5, 5, 1, 1)
    assert settled(accepted(tagged).unionByName(accepted(tagged)), quarantined(tagged)) == (12, 12, 5, 1, -6)


def test_zones(spark, raw_zones):
    extra = spark.createDataFrame(
        [(1, "EWR", "Newark Airport", "EWR"), (2, "n/a", "Nowhere", "x"), (2, "Bronx", "Aa", "x"), (None, "Q", "Q", "q")],
        raw_zones.schema,
    )
    zones = {r["location_id"]: r for r in conform_zones(raw_zones.unionByName(extra)).collect()}
    assert len(zones) == 9
    assert zones[90]["borough"] == "Desconhecido" and zones[90]["zone"] == "Zona nao informada"
    assert zones[90]["service_zone"] == "n/a" and zones[91]["borough"] == "Desconhecido"
    assert zones[40]["service_zone"] == "airports" and zones[1]["borough"] == "Ewr"
    assert zones[2]["borough"] == "Bronx"
