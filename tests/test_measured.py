"""Counts of the writing job in the place of questions to the table."""

import pytest
from pyspark.sql import functions as F

from siltstone.contracts import Expectation
from siltstone.operators.expectations import evaluate
from siltstone.sources import measured, tables

BIG = {"big": "n >= 3", "none": "n IS NULL"}


def rows(spark, *given):
    return spark.createDataFrame(list(given), "n int, load_month string")


def put(spark, table, df, scope, log=None):
    load = tables.load_partitions(df, table, scope, counting=BIG)
    measured.keep(spark, log or f"{table}_log", "silver.t", load, BIG)
    return load


def told(spark, table, scope, predicates=tuple(BIG.values())):
    return measured.counts(spark, f"{table}_log", "silver.t", table, scope, list(predicates))


def test_the_writing_job_counts(spark, database):
    table = f"{database}.t"
    df = rows(spark, (1, "a"), (3, "a"), (4, "b"), (None, "b"), (9, "b")).repartition(3)
    load = put(spark, table, df, ["a", "b", "c"])
    assert (load.rows, load.written, load.counted) == (5, ("a", "b"), {"big": 3, "none": 1})
    assert told(spark, table, ["a", "b"]) == {"n >= 3": 3, "n IS NULL": 1}
    assert told(spark, table, ["a", "b", "c", "unheard"]) == {"n >= 3": 3, "n IS NULL": 1}
    assert told(spark, table, ["a", "b"], ["n > 100"]) == {}


def test_counts_of_several_loads_add_up(spark, database):
    table = f"{database}.t"
    put(spark, table, rows(spark, (3, "a"), (1, "a")), ["a"])
    put(spark, table, rows(spark, (5, "b"), (6, "b")), ["b"])
    assert told(spark, table, ["a", "b"])["n >= 3"] == 3
    assert told(spark, table, ["b"])["n >= 3"] == 2


def test_counts_hold_only_for_the_rows_of_the_load(spark, database):
    table = f"{database}.t"
    assert told(spark, table, ["a"]) == {}
    put(spark, table, rows(spark, (3, "a"), (5, "b")), ["a", "b"])
    assert told(spark, table, ["a"]) == {}, "the load counted both partitions together"
    put(spark, table, rows(spark, (7, "b"), (8, "b")), ["b"])
    assert told(spark, table, ["a", "b"]) == {}, "one partition of the first load was replaced"
    assert told(spark, table, ["b"])["n >= 3"] == 2
    spark.sql(f"INSERT INTO {table} PARTITION (load_month = 'b') VALUES (100)")
    assert told(spark, table, ["b"]) == {}, "rows were added to the folder of the load"
    tables.replace_partitions(rows(spark, (8, "b")), table, ["b"])
    assert told(spark, table, ["b"]) == {}, "written by a job that counted nothing"


def test_an_empty_load_and_a_stopped_one(spark, database):
    table = f"{database}.t"
    assert put(spark, table, rows(spark), ["a"]).counted == {"big": 0, "none": 0}
    assert told(spark, table, ["a"]) == {"n >= 3": 0, "n IS NULL": 0}
    put(spark, table, rows(spark, (3, "a")), ["a"])
    with pytest.raises(Exception, match="outside the replaced partitions"):
        tables.load_partitions(rows(spark, (9, "z")), table, ["a"], counting=BIG)
    assert told(spark, table, ["a"])["n >= 3"] == 1


def test_a_predicate_on_a_strange_name(spark, database):
    table = f"{database}.t"
    wanted = Expectation.of_rows("braces", "text = '{x}'", "== 1")
    df = rows(spark, (1, "a")).withColumn("text", F.lit("{x}"))
    load = tables.load_partitions(df.select("n", "text", "load_month"), table, ["a"], counting={wanted.name: wanted.predicate})
    asked = evaluate(spark, [wanted], "silver.t", "run", {"table": spark.table(table)}).first()
    counted = evaluate(spark, [wanted], "silver.t", "run", {}, load.counted).first()
    assert asked["observed"] == counted["observed"] == 1 and asked["passed"] and counted["passed"]


def test_counted_expectations_read_nothing(spark, database):
    wanted = [Expectation.of_rows("big", "n >= 3", "<= 2", "warn"), Expectation("all", "SELECT count(*) FROM {table}", "> 0")]
    table = rows(spark, (1, "a"))
    both = evaluate(spark, wanted, "silver.t", "run", {"table": table}, {"big": 3})
    assert {r["expectation"]: (r["observed"], r["passed"]) for r in both.collect()} == {"big": (3, False), "all": (1, True)}
    alone = evaluate(spark, wanted[:1], "silver.t", "run", {}, {"big": 3})
    assert "Scan parquet" not in alone._jdf.queryExecution().toString()
