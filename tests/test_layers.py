"""Whole runs over files landed by month."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltstone.contracts import Expectation
from siltstone.domains.trips import TRIPS
from siltstone.operators.expectations import ExpectationFailed
from siltstone.operators.history import snapshot_diff
from siltstone.operators.star import location_lookup
from siltstone.plans import layers, marts
from siltstone.plans.layers import Lakehouse, months_given, read_star, run_layers
from siltstone.sources import landing, measured, tables
from siltstone.streaming.incremental import ROW_KEY, ingest_new_files, refresh_fact

LINEAGE = ("load_month", "_ingested_at", "_source_file", "_batch_id")


def land(spark, raw, root, month, shift=0):
    moved = raw.drop(*LINEAGE)
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        moved = moved.withColumn(name, F.col(name) + F.make_interval(months=F.lit(shift)))
    moved.write.parquet(f"{root}/landing/yellow_tripdata_{month}.parquet")


@pytest.fixture()
def lake(spark, raw_trips, raw_zones, tmp_path, database):
    root = str(tmp_path)
    land(spark, raw_trips, root, "2024-01")
    # The next month's file has other types and one column more.
    wider = raw_trips.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    land(spark, wider.withColumn("cbd_congestion_fee", F.lit(0.75)), root, "2024-02", shift=1)
    raw_zones.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{root}/zones")
    names = {layer: f"{database}_{layer}" for layer in ("bronze", "silver", "gold")}
    return Lakehouse(
        domain=TRIPS, landing=f"{root}/landing", zones=f"{root}/zones", raw_root=f"{root}/raw",
        schemas=names, clustering={"gold.fct_trips": ("pickup_date_key", "pickup_location_key")},
    )


def facts(spark, lake):
    columns = [c for c in spark.table(lake.fact).columns]
    return sorted(map(str, spark.table(lake.fact).select(*columns).collect()))


def test_months_may_be_one_text():
    assert months_given("2024-01 2024-02") == months_given(["2024-01", "2024-02"]) == ["2024-01", "2024-02"]


def test_unknown_layer(spark, lake):
    with pytest.raises(ValueError):
        run_layers(spark, lake, "2024-01", layer="platinum")


def test_all_layers_together_and_month_by_month(spark, lake):
    counts = run_layers(spark, lake, "2024-01 2024-02")
    assert counts["bronze"] == {"zones": 6, "2024-01": 12, "2024-02": 12}
    assert counts["silver"] == {"valid": 12, "quarantined": 10}
    assert counts["gold"] == {"fct_trips": 12}
    first = facts(spark, lake)
    assert len(first) == 12
    fees = spark.table(lake.fact).groupBy("load_month").agg(F.sum("cbd_congestion_fee_amount")).collect()
    assert {r[0]: str(r[1]) for r in fees} == {"2024-01": "0.00", "2024-02": "4.50"}

    run_layers(spark, lake, "2024-01")
    run_layers(spark, lake, ["2024-02"])
    assert facts(spark, lake) == first
    assert spark.table(lake.table("gold", "dim_date")).count() == 31 + 29
    assert spark.table(lake.table("gold", "dim_location")).count() == 7

    history = spark.table(lake.table("gold", "dq_results"))
    assert history.where("passed").count() == history.count() == 3 * 6
    assert history.select("run_id").distinct().count() == 3

    star = read_star(spark, lake)
    row = marts.revenue_by_month_and_payment(star).where("year_month = '2024-01'").collect()
    assert [(r["payment_type_name"], str(r["receita"])) for r in row] == [
        ("Contestada", "312.50"), ("Cartao de credito", "73.20"), ("Dinheiro", "26.00"), ("Nao informado", "16.75"), ("Sem cobranca", "9.10"),
    ]
    rates = marts.quarantine_rate(spark.table(lake.valid), spark.table(lake.quarantine)).collect()
    assert [(r["aceitas"], r["rejeitadas"], r["pct_rejeicao"]) for r in rates] == [(6, 5, 45.455)] * 2
    batches = landing.batches(landing.lineage_of(spark, lake.raw_root)).collect()
    assert [(r["load_month"], r["linhas"]) for r in batches] == [("2024-01", 12), ("2024-02", 12)]
    top = marts.top_flows(star, more_than=1)
    flows = {r["embarque"]: r["corridas"] for r in top.collect()}
    assert flows["Hillside / North Airport"] == 2 and len(flows) == 5
    kind = {r["tipo_embarque"] for r in marts.airport_versus_city(star).collect()}
    assert kind == {"Aeroporto", "Urbana"}
    hours = {r["hour"]: r["corridas"] for r in marts.trips_by_hour(star).collect()}
    assert len(hours) == 24 and hours[12] == 2 and hours[3] == 0


def test_failed_expectation_is_recorded_before_it_stops_the_run(spark, lake):
    strict = replace(
        TRIPS,
        expectations={
            "silver.fct_source_trips": (
                Expectation("none_at_all", "SELECT count(*) FROM {table}", "== 0"),
                Expectation("just_a_warning", "SELECT count(*) FROM {table}", "== 0", "warn"),
            )
        },
    )
    lake = replace(lake, domain=strict)
    with pytest.raises(ExpectationFailed, match="none_at_all"):
        run_layers(spark, lake, "2024-01")
    found = spark.table(lake.table("gold", "dq_results")).collect()
    assert {(r["expectation"], r["passed"], r["observed"]) for r in found} == {
        ("none_at_all", False, 6), ("just_a_warning", False, 6),
    }
    assert not spark.catalog.tableExists(lake.fact)
    run_layers(spark, lake, "2024-01", layer="silver", skip_quality=True)


def test_renamed_zone_keeps_old_facts(spark, lake, raw_zones):
    run_layers(spark, lake, "2024-01")
    renamed = raw_zones.withColumn("Zone", F.when(F.col("LocationID") == 40, "North Airport II").otherwise(F.col("Zone")))
    renamed.write.mode("overwrite").option("header", True).csv(lake.zones)
    run_layers(spark, lake, "2024-02")
    star = read_star(spark, lake)
    seen = star.fact.join(star.locations, F.col("pickup_location_key") == F.col("location_key"))
    assert seen.count() == star.fact.count() == 12
    zones = {(r["load_month"], r["zone"]) for r in seen.where("location_id = 40").collect()}
    assert zones == {("2024-01", "North Airport"), ("2024-02", "North Airport II")}


def test_source_table_is_cut_by_month(spark, raw_trips, database):
    source = f"{database}.samples"
    raw_trips.drop(*LINEAGE).write.saveAsTable(source)
    january = landing.table_month(spark, source, "tpep_pickup_datetime", "2024-01")
    february = landing.table_month(spark, source, "tpep_pickup_datetime", "2024-02")
    assert january.count() == 11 and february.count() == 1
    assert january.where("_source_file LIKE '%.parquet'").count() == 11
    assert {r[0] for r in january.select("load_month").collect()} == {"2024-01"}


def test_zone_lookup_with_a_bad_number(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,A,B,C\nx,A,B,C\n")
    zones = landing.read_zones(spark, str(tmp_path / "z.csv"))
    assert sorted(str(r["LocationID"]) for r in zones.collect()) == ["1", "None"]


def test_new_files_are_taken_once(spark, raw_trips, tmp_path):
    root = str(tmp_path)
    source = raw_trips.drop(*LINEAGE)

    def take():
        ingest_new_files(
            spark, f"{root}/landing/*", source.schema, f"{root}/raw", f"{root}/checkpoint", 1
        ).awaitTermination()
        return {
            r["load_month"]: r["linhas"]
            for r in landing.batches(spark.read.parquet(f"{root}/raw")).collect()
        }

    land(spark, raw_trips, root, "2024-01")
    assert take() == {"2024-01": 12}
    assert take() == {"2024-01": 12}
    land(spark, raw_trips, root, "2024-02", shift=1)
    assert take() == {"2024-01": 12, "2024-02": 12}


def test_streamed_files_go_through_silver(spark, lake, raw_trips, tmp_path):
    run_layers(spark, lake, "2024-01", skip_quality=True)
    by_batch = facts(spark, lake)
    streamed = replace(lake, raw_root=f"{tmp_path}/streamed", streamed=True)
    schema = raw_trips.drop(*LINEAGE).schema
    ingest_new_files(
        spark, f"{lake.landing}/*2024-01*", schema, streamed.raw_root, f"{tmp_path}/checkpoint"
    ).awaitTermination()
    for layer in ("silver", "gold"):
        run_layers(spark, streamed, "2024-01", layer=layer)
    assert facts(spark, streamed) == by_batch
    staging = spark.sql("SHOW TABLES IN siltstone_staging").collect()
    assert staging == []


def test_fact_follows_changed_rows(spark, lake):
    run_layers(spark, lake, "2024-01 2024-02")
    before = spark.table(lake.valid)
    after = before.where("load_month = '2024-01' OR vendor_id = 1").withColumn(
        "tip_amount", F.when(F.col("load_month") == "2024-02", F.lit(1).cast("decimal(10,2)")).otherwise(F.col("tip_amount"))
    )
    lookup = location_lookup(spark.table(lake.table("gold", "dim_location")))
    january = [f for f in facts(spark, lake) if "2024-01" in f]
    assert refresh_fact(lake.fact, before, after, lookup, TRIPS) == ["2024-02"]
    rows = spark.table(lake.fact).where("load_month = '2024-02'").collect()
    assert [str(r["tip_amount"]) for r in rows] == ["1.00"] * 2
    assert [f for f in facts(spark, lake) if "2024-01" in f] == january
    assert refresh_fact(lake.fact, after, after, lookup, TRIPS) == []
    assert snapshot_diff(before, after, ROW_KEY).count() == 6


def test_a_landed_file_without_a_month_is_refused(spark, raw_trips, tmp_path):
    source = raw_trips.drop(*LINEAGE)
    source.write.parquet(f"{tmp_path}/landing/trips_of_january.parquet")
    query = ingest_new_files(
        spark, f"{tmp_path}/landing/*", source.schema, f"{tmp_path}/raw", f"{tmp_path}/checkpoint"
    )
    with pytest.raises(Exception, match="without a month"):
        query.awaitTermination()


def test_a_lost_row_stops_the_run(spark, lake):
    from siltstone.plans.layers import settle

    run_layers(spark, lake, "2024-01", layer="bronze")
    run_layers(spark, lake, "2024-01", layer="silver")
    settle(spark, lake, ["2024-01"])
    kept = spark.table(lake.valid).where("vendor_id IS NULL OR vendor_id <> 6").cache()
    kept.count()
    tables.replace_partitions(kept, lake.valid, ["2024-01"])
    with pytest.raises(ExpectationFailed, match="2024-01: 1"):
        settle(spark, lake, ["2024-01"])


def test_months_of_one_schema_are_one_scan(spark, lake):
    run_layers(spark, lake, "2024-01 2024-02", layer="bronze")
    recorded = {r["load_month"]: r["schema"] for r in spark.table(lake.schemas_table).collect()}
    assert set(recorded) == {"2024-01", "2024-02"} and len(set(recorded.values())) == 2
    both = landing.raw_months(spark, lake.raw_root, ["2024-01", "2024-02"], schemas=recorded)
    assert [df.count() for df in both] == [12, 12]
    spark.read.parquet(f"{lake.raw_root}/load_month=2024-01").write.parquet(f"{lake.raw_root}/load_month=2024-03")
    three = landing.raw_months(spark, lake.raw_root, ["2024-01", "2024-02", "2024-03"], schemas=recorded)
    assert sorted(df.count() for df in three) == [12, 24]
    assert {r[0] for df in three for r in df.select("load_month").distinct().collect()} == {"2024-01", "2024-02", "2024-03"}


def test_row_counts_of_a_run_are_those_of_its_tables(spark, lake):
    """Whether the writing job counted or the tables are asked, a run records the same."""
    domain = replace(
        TRIPS,
        expectations={
            "silver.fct_source_trips": (Expectation.of_rows("long_rides", "trip_duration_min > 30", "<= 100"),),
            "gold.fct_trips": (Expectation.of_rows("tipped", "tip_pct > 0", "<= 100"),),
        },
    )
    lake = replace(lake, domain=domain)

    def recorded(run_id):
        history = spark.table(lake.table("gold", "dq_results")).where(F.col("run_id") == run_id)
        return {r["expectation"]: r["observed"] for r in history.collect()}

    def check(months, run_id):
        for target in domain.expectations:
            layers.check_layer(spark, lake, target, months, run_id)
        return recorded(run_id)

    def asked(months):
        by_month = F.col("load_month").isin(*months)
        long_rides = spark.table(lake.valid).where(by_month & (F.col("trip_duration_min") > 30)).count()
        return {"long_rides": long_rides, "tipped": spark.table(lake.fact).where(by_month & (F.col("tip_pct") > 0)).count()}

    both = ["2024-01", "2024-02"]
    run_layers(spark, lake, both)
    predicates = ["trip_duration_min > 30"]
    held = measured.counts(spark, lake.measured, "silver.fct_source_trips", lake.valid, both, predicates)
    assert held == {predicates[0]: asked(both)["long_rides"]} and held[predicates[0]] > 0
    assert check(both, "whole") == asked(both)
    assert check(["2024-02"], "part") == asked(["2024-02"])
    run_layers(spark, lake, "2024-01")
    assert check(both, "mixed") == asked(both)
    spark.table(lake.valid).limit(1).write.insertInto(lake.valid)
    assert check(both, "added") == asked(both)
