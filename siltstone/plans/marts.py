"""Analytic, observability and summary queries over the layers.

Every query over the star first adds the fact up by the dimension keys it needs and joins the
labels to those sums. The joins therefore meet one row per combination of keys, the scan of the
fact feeds a partial aggregation directly, and a key that holds a third of all rows is a single
row before anything is exchanged. Means are exact, from whole-number sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean_of_money, mean_of_units, units
from ..operators.star import Star

# Name of each averaged measure, its fact column and the decimals that column is rounded to.
_MEASURES = {
    "km": ("trip_distance_km", 3),
    "minutes": ("trip_duration_min", 2),
    "speed": ("avg_speed_kmh", 2),
    "tip": ("tip_pct", 4),
}


def _sums(fact: DataFrame, *keys: str) -> DataFrame:
    """Additive parts of all measures by dimension keys; unused ones are pruned by Catalyst."""
    parts = [F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue")]
    for name, (column, digits) in _MEASURES.items():
        parts.append(F.sum(units(F.col(column), digits)).alias(name))
        parts.append(F.count(column).alias(f"{name}_rows"))
    return fact.groupBy(*keys).agg(*parts)


def _trips() -> Column:
    return F.sum("trips").alias("corridas")


def _revenue() -> Column:
    return F.sum("revenue").cast("decimal(20,2)").alias("receita")


def _mean(measure: str, rounded_to: int) -> Column:
    digits = _MEASURES[measure][1]
    return mean_of_units(F.sum(measure), F.sum(f"{measure}_rows"), digits, rounded_to)


def _tip_percent(rounded_to: int) -> Column:
    """Mean of a ratio, as a percentage: a hundred times is two decimals fewer."""
    return mean_of_units(F.sum("tip"), F.sum("tip_rows"), _MEASURES["tip"][1] - 2, rounded_to)


def _mean_ticket() -> Column:
    return mean_of_money(F.sum("revenue"), F.sum("trips")).alias("ticket_medio")


def _with_dates(sums: DataFrame, star: Star, *columns: str) -> DataFrame:
    days = star.dates.select(F.col("date_key").alias("pickup_date_key"), *columns)
    return sums.join(days, "pickup_date_key")


def _with_clock(sums: DataFrame, star: Star, *columns: str) -> DataFrame:
    minutes = star.clock.select(F.col("time_key").alias("pickup_time_key"), *columns)
    return sums.join(minutes, "pickup_time_key")


def _with_location(sums: DataFrame, star: Star, role: str, *columns: Column | str) -> DataFrame:
    key = f"{role}_location_key"
    return sums.join(star.locations.select(F.col("location_key").alias(key), *columns), key)


def revenue_by_month_and_payment(star: Star) -> DataFrame:
    sums = _with_dates(_sums(star.fact, "pickup_date_key", "payment_type_key"), star, "year_month")
    return (
        sums.join(star.payment_types, "payment_type_key")
        .groupBy("year_month", "payment_type_name")
        .agg(
            _trips(), _revenue(), _mean_ticket(), _tip_percent(2).alias("gorjeta_media_pct")
        )
        .orderBy("year_month", F.desc("receita"), "payment_type_name")
    )


def top_flows(star: Star, more_than: int = 100, rows: int = 15) -> DataFrame:
    """The origin -> destination pairs with the highest revenue; one dimension plays both roles."""
    place = F.concat(F.col("borough"), F.lit(" / "), F.col("zone"))
    sums = _sums(star.fact, "pickup_location_key", "dropoff_location_key")
    sums = _with_location(sums, star, "pickup", place.alias("embarque"))
    sums = _with_location(sums, star, "dropoff", place.alias("desembarque"))
    return (
        sums.groupBy("embarque", "desembarque")
        .agg(
            _trips(),
            _mean("km", 2).alias("km_medio"),
            _mean("minutes", 1).alias("minutos_medios"),
            _revenue(),
        )
        .where(F.col("corridas") > more_than)
        .orderBy(F.desc("receita"), "embarque", "desembarque")
        .limit(rows)
    )


def speed_by_hour(star: Star) -> DataFrame:
    plausible = star.fact.where(F.col("avg_speed_kmh").between(1, 120))
    sums = _sums(plausible, "pickup_date_key", "pickup_time_key")
    sums = _with_clock(_with_dates(sums, star, "day_type"), star, "hour", "day_period")
    return (
        sums.groupBy("hour", "day_period", "day_type")
        .agg(
            _trips(),
            _mean("speed", 2).alias("velocidade_media_kmh"),
            _mean("minutes", 1).alias("duracao_media_min"),
        )
        .orderBy("hour", "day_type")
    )


def airport_versus_city(star: Star) -> DataFrame:
    sums = _sums(star.fact, "pickup_location_key", "rate_code_key")
    kind = F.when(F.col("is_airport"), F.lit("Aeroporto")).otherwise(F.lit("Urbana"))
    sums = _with_location(sums, star, "pickup", kind.alias("tipo_embarque"))
    return (
        sums.join(star.rate_codes, "rate_code_key")
        .groupBy("tipo_embarque", "rate_code_name")
        .agg(
            _trips(),
            _mean("km", 2).alias("km_medio"),
            _mean_ticket(),
            _tip_percent(2).alias("gorjeta_media_pct"),
        )
        .orderBy(F.desc("corridas"), "tipo_embarque", "rate_code_name")
    )


def weekday_by_period(star: Star) -> DataFrame:
    """Ordered by the number of the weekday, which is not shown."""
    sums = _sums(star.fact, "pickup_date_key", "pickup_time_key")
    sums = _with_clock(
        _with_dates(sums, star, "day_of_week", "day_name"), star, "day_period"
    )
    return (
        sums.groupBy("day_of_week", "day_name", "day_period")
        .agg(_trips(), _revenue())
        .orderBy("day_of_week", "day_period")
        .select("day_name", "day_period", "corridas", "receita")
    )


def quarantine_rate(valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Accepted and rejected rows per month, months without rejects included."""
    both = valid.select("load_month", F.lit(True).alias("_ok")).unionByName(
        quarantine.select("load_month", F.lit(False).alias("_ok"))
    )
    counts = both.groupBy("load_month").agg(
        F.count_if("_ok").alias("aceitas"), F.count_if(~F.col("_ok")).alias("rejeitadas")
    )
    total = F.col("aceitas") + F.col("rejeitadas")
    percent = mean_of_units(F.col("rejeitadas") * 100, total, 0, 3)
    return counts.withColumn("pct_rejeicao", percent).orderBy("load_month")


def period_by_borough(star: Star) -> DataFrame:
    return _period_by_borough(star).drop("gorjeta_media_pct")


def top_period_by_borough(star: Star, rows: int = 20) -> DataFrame:
    return _period_by_borough(star).limit(rows)


def _period_by_borough(star: Star) -> DataFrame:
    sums = _sums(star.fact, "pickup_time_key", "pickup_location_key")
    sums = _with_location(_with_clock(sums, star, "day_period"), star, "pickup", "borough")
    return (
        sums.groupBy("day_period", "borough")
        .agg(
            _trips(),
            _mean("km", 2).alias("km_medio"),
            _tip_percent(1).alias("gorjeta_media_pct"),
            _revenue(),
        )
        .orderBy(F.desc("receita"), "day_period", "borough")
    )


def summary(raw: DataFrame, quarantine: DataFrame, fact: DataFrame) -> DataFrame:
    """The headline numbers as one row. Tips are related to fares as sums, never as mean ratios."""
    empty = {
        "corridas_ingeridas": F.lit(0).cast("bigint"),
        "rejeitadas": F.lit(0).cast("bigint"),
        "corridas_fato": F.lit(0).cast("bigint"),
        "receita": F.lit(0).cast("decimal(20,2)"),
        "gorjetas": F.lit(0).cast("decimal(20,2)"),
        "tarifas": F.lit(0).cast("decimal(20,2)"),
    }

    def part(df: DataFrame, **given: Column) -> DataFrame:
        row = df.agg(*[F.coalesce(c, empty[n]).alias(n) for n, c in given.items()])
        return row.select(*[F.col(n) if n in given else c.alias(n) for n, c in empty.items()])

    rows = F.count(F.lit(1))
    parts = (
        part(raw, corridas_ingeridas=rows)
        .unionByName(part(quarantine, rejeitadas=rows))
        .unionByName(
            part(
                fact,
                corridas_fato=rows,
                receita=F.sum("total_amount").cast("decimal(20,2)"),
                gorjetas=F.sum("tip_amount").cast("decimal(20,2)"),
                tarifas=F.sum("fare_amount").cast("decimal(20,2)"),
            )
        )
    )
    totals = parts.agg(*[F.sum(name).cast("decimal(20,2)").alias(name) for name in empty])
    checked = F.col("corridas_fato") + F.col("rejeitadas")

    def ratio(part_of: Column, whole: Column, digits: int) -> Column:
        whole = F.nullif(whole.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
        return F.round(part_of.cast("decimal(20,2)") / whole, digits).cast("double")

    return totals.select(
        F.col("corridas_ingeridas").cast("bigint").alias("corridas_ingeridas"),
        F.col("corridas_fato").cast("bigint").alias("corridas_fato"),
        ratio(F.col("rejeitadas") * 100, checked, 2).alias("taxa_quarentena_pct"),
        F.col("receita"),
        ratio(F.col("receita"), F.col("corridas_fato"), 2).alias("ticket_medio"),
        ratio(F.col("gorjetas") * 100, F.col("tarifas"), 1).alias("gorjeta_sobre_tarifa_pct"),
    )


def trips_by_hour(star: Star) -> DataFrame:
    """All 24 hours, with 0 for an hour without trips."""
    used = _sums(star.fact, "pickup_time_key").select("pickup_time_key", "trips")
    minutes = star.clock.select(F.col("time_key").alias("pickup_time_key"), "hour")
    return (
        minutes.join(used, "pickup_time_key", "left")
        .groupBy("hour")
        .agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("corridas"))
        .orderBy("hour")
    )


def revenue_by_period(star: Star) -> DataFrame:
    return (
        _with_clock(_sums(star.fact, "pickup_time_key"), star, "day_period")
        .groupBy("day_period")
        .agg(_revenue(), _trips())
        .orderBy("day_period")
    )


def revenue_by_borough(star: Star) -> DataFrame:
    return (
        _with_location(_sums(star.fact, "pickup_location_key"), star, "pickup", "borough")
        .groupBy("borough")
        .agg(_revenue(), _trips())
        .orderBy(F.desc("receita"), "borough")
    )


def layer_counts(raw: DataFrame, valid: DataFrame, quarantine: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of each layer, counted where they lie and added up as four partial counts."""
    layers = {"bronze": raw, "silver": valid, "quarentena": quarantine, "gold": fact}
    counted = None
    for name, layer in layers.items():
        row = layer.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("camada"), "linhas"
        )
        counted = row if counted is None else counted.unionByName(row)
    return counted
