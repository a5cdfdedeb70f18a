"""Row rules: who is accepted, who is quarantined, and why."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Rule


def violations(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order; a rule that is NULL is broken.

    Most rows break none, and for those no list is built and filtered.
    """
    none = F.array().cast("array<string>")
    holds = {rule.name: F.coalesce(F.expr(rule.expression), F.lit(False)) for rule in rules}
    broken = [F.when(~held, F.lit(name)) for name, held in holds.items()]
    if not broken:
        return none
    return F.when(reduce(Column.__and__, holds.values()), none).otherwise(
        F.array_compact(F.array(*broken))
    )


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("_violations", violations(rules))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_violations") == 0).drop("_violations")


def quarantined(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_violations") > 0).withColumn(
        "_quarantined_at", F.current_timestamp()
    )


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    tagged = tag(df, rules)
    return accepted(tagged), quarantined(tagged)


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """Rows per broken rule, most frequent first; a row counts once for each rule it breaks.

    Fixed values: the output names ``motivo`` and ``linhas``.
    """
    return (
        quarantine.select(F.explode("_violations").alias("motivo"))
        .groupBy("motivo")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .orderBy(F.desc("linhas"), "motivo")
    )


def quarantine_sample(
    quarantine: DataFrame, rule: str, rows: int = 20, order: Sequence[str] = ("trip_id",)
) -> DataFrame:
    """Some rows that break ``rule``; ordered, so that the sample is the same each time."""
    return (
        quarantine.where(F.array_contains("_violations", rule)).orderBy(*order).limit(rows)
    )


def reconcile(raw: DataFrame, valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per month: rows ingested = rows accepted + rows quarantined + duplicates removed.

    Duplicates are counted on the raw side alone, as rows beyond the first of each ``trip_id``, so
    ``diferenca`` shows rows that were lost (above 0) or made up (below 0) on the way. Only ids and
    months travel, and copies of an id shrink to one row per task before the exchange.
    """
    each = raw.groupBy("load_month", "trip_id").agg(F.count(F.lit(1)).alias("_copies"))
    ingested = each.groupBy("load_month").agg(
        F.sum("_copies").alias("ingeridas"), F.sum(F.col("_copies") - 1).alias("duplicadas")
    )
    sides = {"ingeridas": F.lit(None), "duplicadas": F.lit(None), "aceitas": F.lit(None), "rejeitadas": F.lit(None)}

    def side(df: DataFrame, *known: str) -> DataFrame:
        return df.select("load_month", *[(F.col(n) if n in known else gap.cast("long").alias(n)) for n, gap in sides.items()])

    def counted(df: DataFrame, name: str) -> DataFrame:
        return side(df.groupBy("load_month").agg(F.count(F.lit(1)).alias(name)), name)

    all_sides = side(ingested, "ingeridas", "duplicadas").unionByName(counted(valid, "aceitas")).unionByName(counted(quarantine, "rejeitadas"))
    totals = all_sides.groupBy("load_month").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sides])
    left = F.col("ingeridas") - F.col("aceitas") - F.col("rejeitadas") - F.col("duplicadas")
    return totals.withColumn("diferenca", left)
