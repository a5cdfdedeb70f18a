"""Generated, listed and conformed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contracts import Codes
from ..functions.columns import UNKNOWN_KEY, blank_to_null, date_key

# Labels that reports show.
UNKNOWN_LABEL = "Nao informado"
UNKNOWN_BOROUGH = "Desconhecido"
UNKNOWN_ZONE = "Zona nao informada"
NO_SERVICE_ZONE = "n/a"
WEEKEND_LABEL = "Fim de semana"
WORKDAY_LABEL = "Dia util"
DAY_PERIODS = ((6, "Madrugada"), (12, "Manha"), (18, "Tarde"), (24, "Noite"))
RUSH_HOURS = ((7, 9), (16, 19))
UNKNOWN_BOROUGH_MARKERS = ("unknown", "n/a")


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day from ``first_day`` to ``last_day`` of the one-row ``bounds``, both included."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    weekend = F.dayofweek(day).isin(1, 7)
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekend.alias("is_weekend"),
        F.when(weekend, F.lit(WEEKEND_LABEL)).otherwise(F.lit(WORKDAY_LABEL)).alias("day_type"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
    )


def calendar_between(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    """A calendar for two given dates."""
    one_row = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"),
        F.lit(last_day).cast("date").alias("last_day"),
    )
    return calendar(one_row)


def calendar_bounds(trips: DataFrame) -> DataFrame:
    """First day of the first month and last day of the last month the trips touch.

    Drop-offs count too: a trip that crosses midnight on the last day needs the day after.
    """
    dropoff = F.to_date("dropoff_datetime")
    return trips.agg(
        F.trunc(F.min(F.least("pickup_date", dropoff)), "month").alias("first_day"),
        F.last_day(F.max(F.greatest("pickup_date", dropoff))).alias("last_day"),
    )


def clock(spark: SparkSession) -> DataFrame:
    """The 1440 minutes of a day."""
    minute_of_day = F.col("id").cast("int")
    hours = spark.range(24 * 60).select(
        F.floor(minute_of_day / 60).cast("int").alias("hour"),
        (minute_of_day % 60).cast("int").alias("minute"),
    )
    hour, minute = F.col("hour"), F.col("minute")
    period = F.lit(DAY_PERIODS[-1][1])
    for end, label in reversed(DAY_PERIODS[:-1]):
        period = F.when(hour < end, F.lit(label)).otherwise(period)
    rush = F.lit(False)
    for start, end in RUSH_HOURS:
        rush = rush | hour.between(start, end)
    return hours.select(
        (hour * 100 + minute).cast("int").alias("time_key"),
        hour,
        minute,
        F.format_string("%02d:%02d", hour, minute).alias("time_label"),
        period.alias("day_period"),
        rush.alias("is_rush_hour"),
    )


def fixed_rows(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A few given rows as part of the plan, so that Spark knows how small they are."""
    schema = StructType.fromDDL(columns)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def code_dimension(spark: SparkSession, codes: Codes) -> DataFrame:
    """A listed dimension together with its unknown member."""
    return fixed_rows(spark, [*codes.rows, codes.unknown], codes.columns)


def conform_zones(raw: DataFrame) -> DataFrame:
    """One clean row per location id.

    The unknown markers are recognised before title-casing would alter them. Repeated ids keep the
    row whose attributes come first in order, whatever the file order was; min over a struct is
    partially aggregated before the exchange.
    """
    borough = blank_to_null(F.col("Borough"))
    cleaned = raw.select(
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.when(
            borough.isNull() | F.lower(borough).isin(*UNKNOWN_BOROUGH_MARKERS),
            F.lit(UNKNOWN_BOROUGH),
        )
        .otherwise(F.initcap(borough))
        .alias("borough"),
        F.coalesce(blank_to_null(F.col("Zone")), F.lit(UNKNOWN_ZONE)).alias("zone"),
        F.coalesce(F.lower(blank_to_null(F.col("service_zone"))), F.lit(NO_SERVICE_ZONE)).alias(
            "service_zone"
        ),
    )
    attributes = F.struct("borough", "zone", "service_zone")
    return (
        cleaned.groupBy("location_id")
        .agg(F.min(attributes).alias("kept"))
        .select("location_id", "kept.borough", "kept.zone", "kept.service_zone")
    )


def locations(zones: DataFrame, airport_pattern: str) -> DataFrame:
    """Locations with the unknown member and the airport flag, ready to be versioned."""
    unknown = fixed_rows(
        zones.sparkSession,
        [(UNKNOWN_KEY, UNKNOWN_LABEL, UNKNOWN_LABEL, NO_SERVICE_ZONE)],
        "location_id int, borough string, zone string, service_zone string",
    )
    listed = zones.where("location_id IS NOT NULL").select(
        "location_id", "borough", "zone", "service_zone"
    )
    return listed.unionByName(unknown).withColumn(
        "is_airport", F.col("zone").rlike(airport_pattern)
    )
