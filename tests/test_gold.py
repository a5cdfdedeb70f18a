from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.domains.trips import AIRPORT_PATTERN, TRIPS
from siltstone.operators import dimensions as dim
from siltstone.operators.history import scd2_merge
from siltstone.operators.star import (
    Star,
    build_fact,
    location_lookup,
    lookup_side,
    measured_bytes,
    orphans,
    point_in_time,
    point_in_time_by_month,
    repeated_ids,
    rowcount_gap,
)
from siltstone.plans.layers import TRACKED
from siltstone.plans.silver import build_trips


def test_calendar(spark):
    days = dim.calendar_between(spark, "2024-02-10", "2024-04-30")
    assert days.count() == 20 + 31 + 30 and days.where("full_date = date'2024-02-29'").count() == 1
    weekend = days.where("is_weekend AND full_date <= date'2024-02-13'").select("date_key")
    assert sorted(r[0] for r in weekend.collect()) == [20240210, 20240211]
    row = days.where("date_key = 20240430").first().asDict()
    assert row["month_name"] == "April" and row["day_name"] == "Tuesday"
    assert row["is_month_end"] and not row["is_month_start"] and row["day_of_week"] == 3
    assert len(days.columns) == 16


def test_calendar_bounds_cover_the_dropoff(spark):
    trips = spark.sql(
        "SELECT date'2024-01-31' AS pickup_date, timestamp'2024-02-01 00:10:00' AS dropoff_datetime"
    )
    assert dim.calendar_bounds(trips).first()[:] == (date(2024, 1, 1), date(2024, 2, 29))


def test_clock(spark):
    clock = dim.clock(spark)
    assert clock.count() == 1440
    by_key = {r["time_key"]: r for r in clock.collect()}
    assert by_key[705]["day_period"] == "Manha" and by_key[705]["is_rush_hour"]
    assert by_key[705]["time_label"] == "07:05"
    assert by_key[0]["day_period"] == "Madrugada" and by_key[1200]["day_period"] == "Tarde"
    assert by_key[1800]["day_period"] == "Noite" and not by_key[2000]["is_rush_hour"]


@pytest.mark.parametrize("codes, rows", [(TRIPS.vendors, 5), (TRIPS.rate_codes, 8), (TRIPS.payment_types, 8)])
def test_code_dimensions_have_an_unknown_member(spark, codes, rows):
    members = dim.code_dimension(spark, codes)
    assert members.count() == rows and members.where(f"{codes.key} = -1").count() == 1


@pytest.fixture()
def dim_location(raw_zones):
    zones = dim.conform_zones(raw_zones)
    return scd2_merge(None, dim.locations(zones, AIRPORT_PATTERN), ["location_id"], TRACKED, "2024-01-01")


def test_locations(dim_location):
    assert dim_location.count() == 7
    assert dim_location.where("location_id = 40").first()["is_airport"] is True
    assert dim_location.where("location_id = -1").first()["zone"] == "Nao informado"


def fact_of(raw_trips, dim_location):
    valid, _ = build_trips(raw_trips, TRIPS)
    return valid, build_fact(valid, location_lookup(dim_location), TRIPS)


def test_fact(raw_trips, dim_location):
    valid, fact = fact_of(raw_trips, dim_location)
    assert fact.count() == valid.count() == fact.select("trip_id").distinct().count() == 6
    assert len(fact.columns) == 28
    keys = [c for c in fact.columns if c.endswith("_key")]
    assert len(keys) == 9
    for key in keys:
        assert fact.where(F.col(key).isNull()).count() == 0
    odd = fact.where("rate_code_key = -1").first()
    assert odd["vendor_key"] == -1 and odd["payment_type_key"] == -1
    assert fact.where("vendor_key = -1").count() == 2
    late = fact.where("pickup_time_key = 2348").first()
    assert (late["pickup_date_key"], late["dropoff_date_key"], late["dropoff_time_key"]) == (20240119, 20240120, 12)


def test_fact_finds_the_version_of_its_day(raw_trips, dim_location, spark):
    changed = dim_location.select("location_id", *TRACKED).withColumn(
        "zone", F.when(F.col("location_id") == 11, "Renamed").otherwise(F.col("zone"))
    )
    two = scd2_merge(dim_location, changed, ["location_id"], TRACKED, "2024-01-25")
    later = raw_trips.where("VendorID = 2 AND trip_distance > 6").withColumns(
        {
            c: F.col(c) + F.expr("interval 8 days")
            for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        }
    )
    valid, fact = fact_of(raw_trips.unionByName(later), two)
    assert fact.count() == valid.count()
    seen = fact.join(two, F.col("pickup_location_key") == F.col("location_key"))
    zones = {
        (r["pickup_date_key"], r["zone"]) for r in seen.where("location_id = 11").collect()
    }
    assert zones == {(20240119, "Ferry Dock"), (20240127, "Renamed")}


def test_unmatched_location_gets_the_unknown_member(raw_trips, dim_location):
    only_one = dim_location.where("location_id IN (40, -1)")
    _, fact = fact_of(raw_trips, only_one)
    seen = fact.join(only_one, F.col("dropoff_location_key") == F.col("location_key"))
    assert seen.count() == 6 and seen.where("location_id <> -1").count() == 0


def test_lookup_above_the_limit_is_not_broadcast(dim_location):
    assert measured_bytes(dim_location) > 0
    small = lookup_side(dim_location)._jdf.queryExecution().logical().toString()
    large = lookup_side(dim_location, limit=10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in small and "broadcast" not in large


def test_join_without_broadcast_gives_the_same_fact(raw_trips, dim_location):
    valid, fact = fact_of(raw_trips, dim_location)
    narrow = location_lookup(dim_location, check_size=False).hint("merge")
    again = build_fact(valid, narrow, TRIPS)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in fact.collect()}


def star_of(spark, fact, dim_location):
    return Star(
        fact=fact,
        dates=dim.calendar_between(spark, "2024-01-01", "2024-01-31"),
        clock=dim.clock(spark),
        locations=dim_location,
        vendors=dim.code_dimension(spark, TRIPS.vendors),
        rate_codes=dim.code_dimension(spark, TRIPS.rate_codes),
        payment_types=dim.code_dimension(spark, TRIPS.payment_types),
    )


def test_orphans(spark, raw_trips, dim_location):
    _, fact = fact_of(raw_trips, dim_location)
    found = {r[0]: r[1] for r in orphans(star_of(spark, fact, dim_location)).collect()}
    assert len(found) == 9 and set(found.values()) == {0}
    broken = fact.withColumn("vendor_key", F.lit(5)).withColumn(
        "pickup_date_key", F.lit(None).cast("int")
    )
    found = {r[0]: r[1] for r in orphans(star_of(spark, broken, dim_location)).collect()}
    assert found["vendor_key"] == 6 and found["pickup_date_key"] == 6 and found["rate_code_key"] == 0


def test_repeated_ids_and_rowcount_gap(raw_trips, dim_location):
    valid, fact = fact_of(raw_trips, dim_location)
    assert repeated_ids(fact).first()[0] == 0
    assert repeated_ids(fact.unionByName(fact)).first()[0] == 6
    row = rowcount_gap(fact.limit(1), valid).first()
    assert (row["fact_rows"], row["silver_rows"], row["observed"]) == (1, 6, 5)


def test_looking_up_by_month_gives_the_same(spark):
    versions = spark.createDataFrame(
        [
            (1, 10, date(1900, 1, 1), date(2024, 1, 14)), (1, 11, date(2024, 1, 15), date(2024, 1, 20)), (1, 12, date(2024, 1, 21), date(9999, 12, 31)),
            (2, 20, date(2024, 2, 10), date(9999, 12, 31)), (3, 30, date(1900, 1, 1), date(2023, 12, 31)),
        ],
        "location_id int, location_key long, effective_from date, effective_to date",
    )
    # half of the rows are of one place, some of none
    facts = spark.range(3000).selectExpr(
        "concat('t', id) AS trip_id", "IF(id % 2 = 0, 1, IF(id % 11 = 0, NULL, int(id % 5))) AS place",
        "IF(id % 97 = 0, NULL, date_add(date'2023-12-20', int(id % 90))) AS day",
    )
    plain = point_in_time(facts, versions, "place", "day", "at")
    by_month = point_in_time_by_month(facts, versions, "place", "day", "at")
    assert by_month.columns == plain.columns
    assert sorted(map(str, by_month.collect())) == sorted(map(str, plain.collect()))
    assert point_in_time_by_month(facts.limit(0), versions, "place", "day", "at").count() == 0
    # the hot place is dealt out
    assert by_month._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") >= 1
