"""The seven columns computed from a conformed trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KM_PER_MILE = 1.609344


def derive(df: DataFrame) -> DataFrame:
    seconds = F.unix_seconds("dropoff_datetime") - F.unix_seconds("pickup_datetime")
    measured = df.withColumns(
        {
            "trip_duration_min": F.round(seconds / F.lit(60.0), 2),
            "trip_distance_km": F.round(F.col("trip_distance_mi") * F.lit(KM_PER_MILE), 3),
        }
    )
    hours = F.col("trip_duration_min") / F.lit(60.0)
    tip_share = F.round(F.col("tip_amount") / F.col("fare_amount"), 4)
    return measured.withColumns(
        {
            # Speed is of the rounded duration, and of nothing when that is not positive.
            "avg_speed_kmh": F.when(
                F.col("trip_duration_min") > 0, F.round(F.col("trip_distance_km") / hours, 2)
            ),
            "tip_pct": F.when(F.col("fare_amount") > 0, tip_share).otherwise(F.lit(0.0)),
            "pickup_date": F.to_date("pickup_datetime"),
            "pickup_hour": F.hour("pickup_datetime"),
            "is_airport_trip": F.col("airport_fee_amount") > 0,
        }
    )
