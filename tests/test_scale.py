"""What travels and what is sorted on the way to silver, by the plans and the files."""

import glob
from datetime import datetime

import pytest

from siltstone.domains.events import EVENTS, raw_events
from siltstone.domains.shipments import SHIPMENTS, raw_shipments
from siltstone.operators import identity
from siltstone.plans.silver import prepare, tagged_trips
from siltstone.sources import tables
from siltstone.sources.workspace import WRITERS, shared_folder, stage, unsorted_writes

DAY = datetime(1996, 3, 5)


@pytest.fixture()
def folder(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    write("customer", [(1, 3), (2, 4)], "c_custkey long, c_nationkey int")
    write("supplier", [(1, 5), (2, 6)], "s_suppkey long, s_nationkey int")
    orders = [(key, key % 2 + 1, DAY, "1-URGENT") for key in range(1, 9)]
    write("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string")
    lines = [(key, key, key % 2 + 1, line, 5.0, price, 0.1, 0.05, "N", datetime(1996, 4, line + 1)) for key in range(1, 9) for line in (1, 2) for price in (100.0, 50.0)]
    write(
        "lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp",
    )
    events = [(key, datetime(2024, 1, day), 1, "view", 9.0, '{"k": 7}') for key in (1, 2, 3, 4, None) for day in (2, 3)]
    write("events", events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    return str(tmp_path)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dealt(df):
    return [line for line in planned(df).splitlines() if "Exchange hashpartitioning" in line]


def test_copies_are_sought_where_the_join_left_them(spark, folder):
    assert len(dealt(prepare(raw_shipments(spark, folder), SHIPMENTS))) == 2  # lines and orders
    assert "trip_id" not in "".join(dealt(tagged_trips(raw_shipments(spark, folder), SHIPMENTS, gather=["load_month"])))
    assert not any("trip_id" in line for line in dealt(prepare(raw_events(spark, folder), EVENTS)))


def test_tasks_that_sort_follow_the_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(identity, "ROWS_PER_TASK", 1)
    lines = dealt(prepare(raw_shipments(spark, folder), SHIPMENTS))
    assert len(lines) == 2 and all("32), REPARTITION_BY_NUM" in line for line in lines)
    events = dealt(prepare(raw_events(spark, folder), EVENTS))
    assert len(events) == 1 and "10), REPARTITION_BY_NUM" in events[0]


@pytest.mark.parametrize("rows_per_task", [1, 1000])
def test_one_row_is_kept_of_every_key_and_month(spark, folder, monkeypatch, rows_per_task):
    monkeypatch.setattr(identity, "ROWS_PER_TASK", rows_per_task)
    kept = prepare(raw_shipments(spark, folder), SHIPMENTS, gather=["load_month"]).collect()
    assert sorted((r["order_key"], r["line_number"], str(r["list_amount"])) for r in kept) == [(k, n, "50.00") for k in range(1, 9) for n in (1, 2)]
    assert len({r["trip_id"] for r in kept}) == 16
    kept = prepare(raw_events(spark, folder), EVENTS).collect()  # those without an id are copies of each other
    assert sorted((r["event_id"] or 0, r["pickup_datetime"].day) for r in kept) == [(k, 3) for k in range(5)]
    # rows that do not come dealt by their key, and months of several schemas
    raw = raw_events(spark, folder).coalesce(1)
    assert prepare([raw.where("event_id < 3"), raw.where("event_id > 1")], EVENTS, rows=12).count() == 4


def test_ids_of_texts_and_floats_are_compared_as_texts(spark):
    df = spark.sql("SELECT 1L AS a, 'x' AS b, 1.0D AS c, 1.50BD AS d, timestamp'2024-01-01' AS e")
    assert identity.copy_key(df, ["a", "d", "e"]) == ["a", "d", "e"]
    assert identity.copy_key(df, ["a", "b"]) is None and identity.copy_key(df, ["a", "c"]) is None


def test_what_is_staged_and_loaded_is_packed(spark, database, tmp_path):
    rows = spark.sql("SELECT sha2(string(id), 256) AS trip_id, '2024-01' AS load_month FROM range(9)")
    stage(rows, "packed")
    assert glob.glob(f"{shared_folder(spark)}/packed-*/*.zstd.parquet")
    place = tables.load_partitions(rows, f"{database}.t", ["2024-01"]).place
    assert glob.glob(f"{place.removeprefix('file:')}/load_month=2024-01/*.zstd.parquet")


def test_ranges_are_cut_by_the_id_and_not_by_all_columns(spark):
    rows = spark.sql("SELECT string(id) AS trip_id, id AS place, id * 2 AS other, '2024-01' AS load_month FROM range(9)")
    (cut,) = [line for line in planned(tables.cluster_rows(rows, ["place"])).splitlines() if "rangepartitioning" in line]
    assert "xxhash64(trip_id" in cut and "other" not in cut


def test_rows_are_not_sorted_to_be_written(spark, database, tmp_path):
    rows = spark.sql("SELECT id, string(id % 3) AS part FROM range(30)")
    before = spark.conf.get(WRITERS, None)
    seen = []
    with unsorted_writes(spark):
        seen.append(spark.conf.get(WRITERS))
    assert seen == ["8"] and spark.conf.get(WRITERS, None) == before
    # more partitions than are written side by side
    many = spark.sql("SELECT id, string(id % 40) AS part FROM range(400)").coalesce(1)
    staged = stage(many, "many", ["part"])
    assert staged.count() == 400 and staged.where("part = '7'").count() == 10
    load = tables.load_partitions(rows.coalesce(1), f"{database}.few", ["0", "1", "2"], by="part", rebalance=False)
    assert load.rows == 30 and len(glob.glob(f"{load.place.removeprefix('file:')}/part=*/*.parquet")) == 3
