import pytest
from pyspark.sql import functions as F

from siltstone.contracts import Expectation
from siltstone.functions.thresholds import meets, meets_column, threshold
from siltstone.operators.expectations import ExpectationFailed, evaluate, failures, gate, latest


@pytest.mark.parametrize(
    "observed, text, passed",
    [(0, "== 0", True), (5, "== 0", False), (3, "<= 5", True), (9, "> 10", False), (1, " !=-2 ", True), (4, "<4", False), (4, ">= 4", True)],
)
def test_comparisons(spark, observed, text, passed):
    assert meets(observed, text) is passed
    assert spark.range(1).select(meets_column(F.lit(observed), text)).first()[0] is passed


@pytest.mark.parametrize("text", ["about zero", "== 0.5", "=> 3", "", "== 0 or so"])
def test_malformed_comparison(text):
    with pytest.raises(ValueError):
        threshold(text)


def check(spark, *wanted):
    table = spark.range(10).toDF("n")
    return evaluate(spark, wanted, "silver.t", "run1", {"table": table, "catalog_prefix": ""})


def test_results_in_one_frame(spark):
    found = check(
        spark,
        Expectation("all", "SELECT count(*)\n  FROM {table}", "== 10"),
        Expectation("few", "SELECT count(*) FROM {table} WHERE n > 5", "<= 2", severity="warn"),
        Expectation("nothing", "SELECT max(n) FROM {table} WHERE n > 50", "== 0"),
    )
    rows = {r["expectation"]: r for r in found.collect()}
    assert rows["all"]["passed"] and rows["all"]["observed"] == 10
    assert not rows["few"]["passed"] and rows["few"]["severity"] == "warn"
    assert rows["nothing"]["observed"] is None and rows["nothing"]["passed"] is False
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("dq_")]


def test_gate_stops_on_failures_only(spark):
    warned = check(spark, Expectation("w", "SELECT count(*) FROM {table}", "== 0", "warn")).collect()
    gate(warned, "silver.t")
    failed = check(spark, Expectation("f", "SELECT count(*) FROM {table}", "== 0")).collect()
    with pytest.raises(ExpectationFailed, match="silver.t: f"):
        gate(failed, "silver.t")


def test_history_reports(spark):
    found = check(
        spark,
        Expectation("a", "SELECT count(*) FROM {table}", "== 10"),
        Expectation("b", "SELECT count(*) FROM {table}", "== 0"),
    )
    assert [r["expectation"] for r in failures(found).collect()] == ["b"]
    assert latest(found, 1).count() == 1


def test_no_row_fails_and_several_rows_or_fractions_stop_the_job(spark):
    row = check(spark, Expectation("none", "SELECT n FROM {table} WHERE n > 50", "== 0")).first()
    assert row["observed"] is None and row["passed"] is False
    with pytest.raises(ExpectationFailed):
        gate([row], "silver.t")
    with pytest.raises(Exception, match="(?i)more than one row|scalar_subquery_too_many_rows"):
        check(spark, Expectation("many", "SELECT n FROM {table}", "== 0")).collect()
    with pytest.raises(Exception, match="with a fraction"):
        check(spark, Expectation("part", "SELECT 0.9 FROM {table} LIMIT 1", "== 0")).collect()
