from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltstone.functions.types import common_type
from siltstone.plans import layers
from siltstone.plans.layers import run_layers
from siltstone.sources.ledger import ingest_landed, ledger
from siltstone.streaming import incremental
from siltstone.streaming.incremental import ingest_new_files, run_increment

from test_layers import LINEAGE, facts, land, lake  # noqa: F401


def month_file(root, month, service="yellow"):
    return f"{root}/landing/{service}_tripdata_{month}.parquet"


def rows(spark, *pairs, schema="id int, v int"):
    return spark.createDataFrame(list(pairs), schema)


def raw(spark, root):
    return {(r["load_month"], r["id"], r["v"]) for r in spark.read.option("mergeSchema", True).parquet(f"{root}/raw").collect()}


def test_a_month_that_lands_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path)

    def take():
        return ingest_landed(spark, f"{root}/landing", f"{root}/raw")

    rows(spark, (1, 1), (2, 2)).write.parquet(month_file(root, "2024-01"))
    rows(spark, (3, 3)).write.parquet(month_file(root, "2024-02"))
    assert take() == ["2024-01", "2024-02"] and take() == []
    rows(spark, (1, 9)).write.mode("overwrite").parquet(month_file(root, "2024-01"))  # other part names
    assert take() == ["2024-01"] and take() == []
    assert raw(spark, root) == {("2024-01", 1, 9), ("2024-02", 3, 3)}
    wider = rows(spark, (4, 4, 0.5), schema="id int, v int, fee double")
    wider.write.mode("append").parquet(month_file(root, "2024-02"))  # one more file with a new column
    assert take() == ["2024-02"]
    assert raw(spark, root) == {("2024-01", 1, 9), ("2024-02", 3, 3), ("2024-02", 4, 4)}
    fees = spark.read.parquet(f"{root}/raw/load_month=2024-02")
    assert {(r["id"], r["fee"]) for r in fees.collect()} == {(3, None), (4, 0.5)}
    assert {r["load_month"] for r in ledger(spark, f"{root}/raw").collect()} == {"2024-01", "2024-02"}


def test_files_of_one_month_with_other_types(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, (1, 1)).write.parquet(month_file(root, "2024-03"))
    rows(spark, (2, 2.5), schema="id bigint, v double").write.mode("append").parquet(month_file(root, "2024-03"))
    ingest_landed(spark, f"{root}/landing", f"{root}/raw")
    taken = spark.read.parquet(f"{root}/raw/load_month=2024-03")
    assert dict(taken.dtypes)["id"] == "bigint" and dict(taken.dtypes)["v"] == "double"
    assert {(r["id"], r["v"]) for r in taken.collect()} == {(1, 1.0), (2, 2.5)}


def test_the_same_name_and_a_file_rewritten_in_place(spark, tmp_path):
    """One plain file, written again under its very name."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "landing").mkdir()
    path = f"{tmp_path}/landing/green_tripdata_2024-05.parquet"
    for values in ([1, 2], [1, 2, 3]):
        pq.write_table(pa.table({"id": values, "v": values}), path)
        assert ingest_landed(spark, f"{tmp_path}/landing", f"{tmp_path}/raw") == ["2024-05"]
        assert spark.read.parquet(f"{tmp_path}/raw/load_month=2024-05").count() == len(values)
    assert ingest_landed(spark, f"{tmp_path}/landing", f"{tmp_path}/raw") == []


def test_a_stopped_ingest_is_repeated(spark, tmp_path, monkeypatch):
    from siltstone.sources import ledger as module

    root = str(tmp_path)
    rows(spark, (1, 1)).write.parquet(month_file(root, "2024-01"))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(module, "schema_text", lambda df: (_ for _ in ()).throw(RuntimeError()))
        ingest_landed(spark, f"{root}/landing", f"{root}/raw")
    assert ingest_landed(spark, f"{root}/landing", f"{root}/raw") == ["2024-01"]
    rows(spark, (1, 1)).write.parquet(f"{root}/landing/without.parquet")
    with pytest.raises(Exception, match="without a month"):
        ingest_landed(spark, f"{root}/landing", f"{root}/raw")


def test_the_stream_keeps_new_columns(spark, tmp_path):
    root = str(tmp_path)

    def take():
        ingest_new_files(spark, f"{root}/landing/*", "id int, v int", f"{root}/raw", f"{root}/checkpoint").awaitTermination()

    rows(spark, (1, 1)).write.parquet(month_file(root, "2024-01"))
    take()
    rows(spark, (2, 2, 0.5), schema="id int, v int, fee double").write.parquet(month_file(root, "2024-02"))
    rows(spark, (1, 8)).write.mode("overwrite").parquet(month_file(root, "2024-01"))
    take()
    assert raw(spark, root) == {("2024-01", 1, 8), ("2024-02", 2, 2)}
    assert "fee" in spark.read.parquet(f"{root}/raw/load_month=2024-02").columns


def test_common_types():
    from pyspark.sql import types as T

    assert common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert common_type(T.LongType(), T.FloatType()) == T.DoubleType()
    assert common_type(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert common_type(T.StringType(), T.IntegerType()) == T.StringType()
    assert common_type(T.NullType(), T.DateType()) == T.DateType()


def test_raw_months_are_one_relation(spark, lake):  # noqa: F811
    run_layers(spark, lake, "2024-01 2024-02", layer="bronze")
    name = lake.table("bronze", "raw_trips")
    counts = {r["load_month"]: r["n"] for r in spark.sql(f"SELECT load_month, count(*) AS n FROM {name} GROUP BY 1").collect()}
    assert counts == {"2024-01": 12, "2024-02": 12}
    run_layers(spark, lake, "2024-02", layer="bronze")
    assert spark.sql(f"SELECT * FROM {name} WHERE load_month = '2024-02'").count() == 12
    plan = spark.sql(f"SELECT VendorID FROM {name} WHERE load_month = '2024-02'")
    assert all("load_month=2024-02" in path for path in plan.inputFiles())


@pytest.fixture()
def area(spark, lake, tmp_path):  # noqa: F811
    return replace(lake, raw_root=f"{tmp_path}/increments", streamed=True)


def batch_run(spark, area, tmp_path):
    """The same landing taken through all layers at once."""
    whole = replace(area, raw_root=f"{tmp_path}/whole", schemas={k: f"{v}_whole" for k, v in area.schemas.items()})
    run_layers(spark, whole, ["2024-01", "2024-02"])
    return facts(spark, whole)


def test_increments_equal_a_whole_run(spark, area, raw_trips, tmp_path):
    assert run_increment(spark, area)["gold"] == ["2024-01", "2024-02"]
    assert run_increment(spark, area) == {"bronze": [], "silver": [], "gold": []}
    january = facts(spark, area)
    changed = raw_trips.withColumn("tip_amount", F.when(F.col("VendorID") == 6, F.lit(2.0)).otherwise(F.col("tip_amount")))
    changed.drop(*LINEAGE).withColumn("fee", F.lit(1)).write.mode("overwrite").parquet(f"{area.landing}/yellow_tripdata_2024-01.parquet")
    assert run_increment(spark, area) == {"bronze": ["2024-01"], "silver": ["2024-01"], "gold": ["2024-01"]}
    assert facts(spark, area) != january
    assert facts(spark, area) == batch_run(spark, area, tmp_path)
    assert "fee" in spark.table(area.table("bronze", "raw_trips")).columns


@pytest.mark.parametrize("stop", ["silver", "fact", "note"])
def test_a_stopped_increment_is_taken_up(spark, area, raw_trips, tmp_path, monkeypatch, stop):
    run_increment(spark, area)
    changed = raw_trips.where("VendorID IS NULL OR VendorID <> 6")
    changed.drop(*LINEAGE).write.mode("overwrite").parquet(f"{area.landing}/yellow_tripdata_2024-01.parquet")

    def broken(*args, **kwargs):
        raise RuntimeError("stopped")

    note = incremental._note
    place = {"silver": (layers, "silver_layer"), "fact": (incremental, "refresh_fact")}
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="stopped"):
        if stop == "note":
            m.setattr(incremental, "_note", lambda s, a, r, step: broken() if step == "done" else note(s, a, r, step))
        else:
            m.setattr(*place[stop], broken)
        run_increment(spark, area)
    run_increment(spark, area)
    assert facts(spark, area) == batch_run(spark, area, tmp_path)
    assert run_increment(spark, area) == {"bronze": [], "silver": [], "gold": []}
