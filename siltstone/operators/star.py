"""The fact table: natural keys out, dimension keys in."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Domain
from ..functions.columns import (
    UNKNOWN_KEY,
    date_key,
    listed_or_unknown,
    time_key,
    version_key,
)
from .history import LOW_DATE

BROADCAST_BYTES = 64 * 1024 * 1024
MONEY = (
    "fare_amount",
    "extra_amount",
    "mta_tax_amount",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge_amount",
    "congestion_surcharge_amount",
    "airport_fee_amount",
    "cbd_congestion_fee_amount",
    "total_amount",
)


@dataclass(frozen=True)
class Star:
    """The fact and the dimensions its keys point to."""

    fact: DataFrame
    dates: DataFrame
    clock: DataFrame
    locations: DataFrame
    vendors: DataFrame
    rate_codes: DataFrame
    payment_types: DataFrame

    def in_months(self, months: Iterable[str]) -> Star:
        """The same star with only these months of the fact, whose other folders are not read."""
        return replace(self, fact=self.fact.where(F.col("load_month").isin(*months)))


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as rows: one aggregate over it, which never brings the rows themselves."""
    width = F.lit(16 + 16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def lookup_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` to be broadcast when its measured size allows it, and as it is when not.

    Above the limit Spark shuffles both sides by key, and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def unknown_location_key() -> Column:
    return version_key([F.lit(UNKNOWN_KEY)], F.lit(LOW_DATE).cast("date"))


def narrow_locations(dim_location: DataFrame) -> DataFrame:
    """What a point-in-time join needs of the dimension: four fixed-width columns."""
    return dim_location.select("location_id", "location_key", "effective_from", "effective_to")


def location_lookup(dim_location: DataFrame, check_size: bool = True) -> DataFrame:
    """The narrow dimension, to be broadcast when its measured size allows it."""
    narrow = narrow_locations(dim_location)
    return lookup_side(narrow) if check_size else narrow


def located_fact(trips: DataFrame, dim_location: DataFrame, domain: Domain, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``build_fact`` the way that the measured size of the dimension asks for."""
    narrow = narrow_locations(dim_location)
    if measured_bytes(narrow) <= limit:
        return build_fact(trips, F.broadcast(narrow), domain)
    return build_fact(trips, narrow, domain, by_month=True)


def point_in_time(
    facts: DataFrame, lookup: DataFrame, location: str, on_date: str, role: str
) -> DataFrame:
    """Add ``{role}_location_key``: the version of ``location`` that held on ``on_date``.

    Ranges of one member do not overlap, so no row is repeated; a row without a version gets the
    unknown member's key.
    """
    versions = lookup.select(
        F.col("location_id").alias("_id"),
        F.col("location_key").alias("_key"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
    )
    held = (F.col(location) == F.col("_id")) & F.col(on_date).between(F.col("_from"), F.col("_to"))
    return (
        facts.join(versions, held, "left")
        .withColumn(f"{role}_location_key", F.coalesce("_key", unknown_location_key()))
        .drop("_id", "_key", "_from", "_to")
    )


HOT_SHARE = 64  #: a place with more than this part of the rows is dealt out
SALTS = 16  #: among which a hot place is dealt out


def hot_places(facts: DataFrame, location: str, total: int) -> list:
    """The places with more than a ``HOT_SHARE``-th of the rows, of which there are fewer than that."""
    counted = facts.where(F.col(location).isNotNull()).groupBy(location).agg(F.count(F.lit(1)).alias("n"))
    return [r[location] for r in counted.where(F.col("n") * HOT_SHARE > total).collect()]


def point_in_time_by_month(
    facts: DataFrame, lookup: DataFrame, location: str, on_date: str, role: str, row: str = "trip_id", measured: DataFrame | None = None
) -> DataFrame:
    """``point_in_time`` for a lookup too large to be sent to the facts.

    Every version is unfolded to the months of the facts in which it held, so both sides meet by place and month and not
    by place alone, and a place with many versions or long ones does not grow into one task. The rows of ``hot_places`` are
    dealt out by a hash of ``row`` as well, and their versions are repeated for each part. ``measured`` are the facts as they
    are read, if ``facts`` are more than that: months and hot places are counted there.
    """
    base = facts if measured is None else measured
    span = base.agg(F.min(on_date).alias("low"), F.max(on_date).alias("high"), F.count(F.lit(1)).alias("n")).first()
    hot = hot_places(base, location, span["n"])
    low, high = (F.trunc(F.lit(span[name]).cast("date"), "month") for name in ("low", "high"))
    begin = F.greatest(F.trunc("effective_from", "month"), low)
    end = F.least(F.trunc("effective_to", "month"), high)
    unfolded = lookup.where(begin <= end).select(
        F.col("location_id").alias("_id"),
        F.col("location_key").alias("_key"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
        F.explode(F.sequence(begin, end, F.expr("INTERVAL 1 MONTH"))).alias("_month"),
    )
    parts = F.when(F.col("_id").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    unfolded = unfolded.withColumn("_part", F.explode(parts))
    part = F.when(F.col(location).isin(hot), F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    keyed = facts.withColumns({"_of_month": F.trunc(on_date, "month"), "_of_part": part})
    held = (
        (F.col(location) == F.col("_id"))
        & (F.col("_of_month") == F.col("_month"))
        & (F.col("_of_part") == F.col("_part"))
        & F.col(on_date).between(F.col("_from"), F.col("_to"))
    )
    return (
        keyed.join(unfolded, held, "left")
        .withColumn(f"{role}_location_key", F.coalesce("_key", unknown_location_key()))
        .drop("_id", "_key", "_from", "_to", "_month", "_part", "_of_month", "_of_part")
    )


def build_fact(trips: DataFrame, lookup: DataFrame, domain: Domain, by_month: bool = False) -> DataFrame:
    """One row per accepted trip. Both locations are taken as of the pickup date.

    ``by_month`` looks them up by ``point_in_time_by_month``, for lookups that are not to be broadcast.
    """
    located = trips
    for location, role in (("pu_location_id", "pickup"), ("do_location_id", "dropoff")):
        if by_month:
            located = point_in_time_by_month(located, lookup, location, "pickup_date", role, measured=trips)
        else:
            located = point_in_time(located, lookup, location, "pickup_date", role)
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return located.select(
        "trip_id",
        date_key(pickup).alias("pickup_date_key"),
        time_key(pickup).alias("pickup_time_key"),
        date_key(dropoff).alias("dropoff_date_key"),
        time_key(dropoff).alias("dropoff_time_key"),
        "pickup_location_key",
        "dropoff_location_key",
        listed_or_unknown(F.col("vendor_id"), domain.vendors.listed).alias("vendor_key"),
        listed_or_unknown(F.col("rate_code_id"), domain.rate_codes.listed).alias("rate_code_key"),
        listed_or_unknown(F.col("payment_type_id"), domain.payment_types.listed).alias(
            "payment_type_key"
        ),
        "store_and_fwd_flag",
        "is_airport_trip",
        "passenger_count",
        "trip_distance_km",
        "trip_duration_min",
        *MONEY,
        "avg_speed_kmh",
        "tip_pct",
        "load_month",
    )


def foreign_keys(star: Star) -> list[tuple[str, DataFrame, str]]:
    return [
        ("pickup_date_key", star.dates, "date_key"),
        ("dropoff_date_key", star.dates, "date_key"),
        ("pickup_time_key", star.clock, "time_key"),
        ("dropoff_time_key", star.clock, "time_key"),
        ("pickup_location_key", star.locations, "location_key"),
        ("dropoff_location_key", star.locations, "location_key"),
        ("vendor_key", star.vendors, "vendor_key"),
        ("rate_code_key", star.rate_codes, "rate_code_key"),
        ("payment_type_key", star.payment_types, "payment_type_key"),
    ]


def orphans(star: Star) -> DataFrame:
    """For every foreign key, the fact rows whose key has no member in its dimension.

    One scan of the fact serves all keys: each is looked up in the members of its dimension, which
    are sent to the fact if their measured size allows it, and one aggregate counts the misses. A
    NULL key has no member.
    """
    checked = foreign_keys(star)
    sides: dict[tuple[int, str], DataFrame] = {}
    looked_up = star.fact.select(*[F.col(name).cast("bigint").alias(name) for name, _, _ in checked])
    for name, dimension, key in checked:
        if (id(dimension), key) not in sides:
            sides[id(dimension), key] = lookup_side(dimension.select(F.col(key).cast("bigint").alias("_member")).distinct())
        members = sides[id(dimension), key].select(F.col("_member").alias(f"_{name}"))
        looked_up = looked_up.join(members, F.col(name) == F.col(f"_{name}"), "left")
    counts = looked_up.agg(*[F.count_if(F.col(f"_{name}").isNull()).alias(name) for name, _, _ in checked])
    each = [F.struct(F.lit(name).alias("foreign_key"), F.col(name).alias("observed")) for name, _, _ in checked]
    return counts.select(F.inline(F.array(*each)))


def repeated_ids(df: DataFrame, key: str = "trip_id") -> DataFrame:
    """How many ids occur more than once."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .agg(F.count(F.lit(1)).alias("observed"))
    )


def rowcount_gap(fact: DataFrame, silver: DataFrame) -> DataFrame:
    """Per month: rows of the fact, of silver, and how far they are apart."""
    both = fact.select("load_month", F.lit(1).alias("_fact")).unionByName(
        silver.select("load_month", F.lit(0).alias("_fact"))
    )
    return (
        both.groupBy("load_month")
        .agg(
            F.count_if(F.col("_fact") == 1).alias("fact_rows"),
            F.count_if(F.col("_fact") == 0).alias("silver_rows"),
        )
        .withColumn("observed", F.abs(F.col("fact_rows") - F.col("silver_rows")))
    )
