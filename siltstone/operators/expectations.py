"""Data-quality expectations: one number per query, compared, recorded, and enforced."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..contracts import Expectation
from ..functions.thresholds import meets_column

RESULT_COLUMNS = (
    "run_at",
    "run_id",
    "target",
    "expectation",
    "severity",
    "observed",
    "expected",
    "passed",
)


class ExpectationFailed(RuntimeError):
    """A blocking expectation was not met."""


def evaluate(
    spark: SparkSession,
    expectations: Sequence[Expectation],
    target: str,
    run_id: str,
    names: Mapping[str, str | DataFrame],
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """One result row per expectation, all in one job.

    Expectations named in ``counted`` are judged by that number, which the job that wrote the rows
    counted (``sources.measured``), and ask nothing.

    ``names`` fills the placeholders of the queries: text is put in as it is, a DataFrame under a
    view made for the purpose. Each query is a scalar subquery of one statement: no row, or NULL, is a
    failed expectation, more than one row and a number with a fraction fail the job. So there are as
    many results as expectations, and Spark may answer several of them by one scan.
    """
    if not expectations:
        raise ValueError(f"no expectations for {target}")
    views = {
        key: f"dq_{key}_{uuid.uuid4().hex}"
        for key, value in names.items()
        if isinstance(value, DataFrame)
    }
    for key, view in views.items():
        names[key].createOrReplaceTempView(view)
    filled = {key: views.get(key, value) for key, value in names.items()}
    try:
        asked = []
        for i, wanted in enumerate(expectations):
            known = (counted or {}).get(wanted.name)
            number = f"({wanted.query.format(**filled)})" if known is None else f"CAST({int(known)} AS bigint)"
            asked.append(f"{number} AS n{i}")
        numbers = spark.sql(f"SELECT {', '.join(asked)}")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
    each = []
    for i, wanted in enumerate(expectations):
        observed = _whole(F.col(f"n{i}"), wanted.name)
        each.append(
            F.struct(
                F.lit(wanted.name).alias("expectation"),
                F.lit(wanted.severity).alias("severity"),
                observed.alias("observed"),
                F.lit(wanted.expect).alias("expected"),
                meets_column(observed, wanted.expect).alias("passed"),
            )
        )
    found = numbers.select(F.inline(F.array(*each)))
    return found.select(
        F.current_timestamp().alias("run_at"), F.lit(run_id).alias("run_id"), F.lit(target).alias("target"), *found.columns
    )


def _whole(number: Column, name: str) -> Column:
    """``number`` as a whole one; a fraction fails the job instead of being cut off."""
    exact = number.cast("decimal(38,9)")
    broken = F.raise_error(F.lit(f"expectation {name} observed a number with a fraction")).cast("bigint")
    return F.when(exact.isNull() | (exact == F.floor(exact)), number.cast("bigint")).otherwise(broken)


def gate(results: Iterable[Row], target: str) -> None:
    """Raise when a result of severity ``fail`` did not pass; warnings never stop a run."""
    failed = [r["expectation"] for r in results if not r["passed"] and r["severity"] == "fail"]
    if failed:
        raise ExpectationFailed(f"blocking expectations not met on {target}: {', '.join(failed)}")


def failures(history: DataFrame) -> DataFrame:
    """Expectations that were not met, newest first."""
    return history.where(~F.col("passed")).orderBy(F.desc("run_at"), "run_id", "target", "expectation")


def latest(history: DataFrame, rows: int = 50) -> DataFrame:
    """The newest results."""
    return (
        history.select(*RESULT_COLUMNS)
        .orderBy(F.desc("run_at"), "run_id", "target", "expectation")
        .limit(rows)
    )
