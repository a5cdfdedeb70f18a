"""Bronze: landed files and tables as they are, plus where each row came from."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..functions.types import common_type

FILE_MONTH = r"_tripdata_([0-9]{4}-[0-9]{2})\.parquet"
TABLES = "_tables"  #: a folder without files, where external tables of the raw area begin
ZONES_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def month_file(landing: str, service: str, month: str) -> str:
    return f"{landing.rstrip('/')}/{service}_tripdata_{month}.parquet"


def with_lineage(raw: DataFrame, month: str, batch_id: str | None = None) -> DataFrame:
    """Source columns untouched, and the file, time, batch and month of their load."""
    return raw.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_ingested_at": F.current_timestamp(),
            "_batch_id": F.lit(batch_id or str(uuid.uuid4())),
            "load_month": F.lit(month),
        }
    )


def read_month(
    spark: SparkSession, landing: str, service: str, month: str, batch_id: str | None = None
) -> DataFrame:
    return with_lineage(spark.read.parquet(month_file(landing, service, month)), month, batch_id)


def table_month(
    spark: SparkSession, table: str, moment: str, month: str, batch_id: str | None = None
) -> DataFrame:
    """One month of an existing table; the range predicate reaches the scan."""
    first = F.to_date(F.lit(f"{month}-01"))
    happened = F.col(moment)
    part = spark.table(table).where((happened >= first) & (happened < F.add_months(first, 1)))
    return with_lineage(part, month, batch_id)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The location lookup: header line, fixed schema, unreadable numbers become NULL."""
    lookup = spark.read.option("header", True).schema(ZONES_SCHEMA).csv(path)
    return lookup.withColumn("_ingested_at", F.current_timestamp())


def only_months(df: DataFrame, months: Iterable[str]) -> DataFrame:
    """Rows of the given load months; on a partitioned table only their folders are read."""
    return df.where(F.col("load_month").isin(*months))


def schema_text(df: DataFrame) -> str:
    """Names and types as text, as they read back from files, where every column may be NULL."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields]).json()


def raw_months(
    spark: SparkSession, root: str, months: Sequence[str], schemas: Mapping[str, str] | None = None
) -> list[DataFrame]:
    """The months of the raw area, one DataFrame for all months whose files have the same schema.

    Sources change types over the years, so months of different schemas meet only after each has been
    brought to the contract. ``schemas`` holds the schema of months as JSON, as it was recorded when
    they were written; the footer of another month is asked for.
    """
    base = root.rstrip("/")
    alike: dict[str, list[str]] = {}
    for month in months:
        folder = f"{base}/load_month={month}"
        known = (schemas or {}).get(month) or schema_text(spark.read.parquet(folder))
        alike.setdefault(known, []).append(folder)
    return [
        spark.read.schema(StructType.fromJson(json.loads(schema)).add("load_month", "string"))
        .option("basePath", base)
        .parquet(*folders)
        for schema, folders in alike.items()
    ]


def publish_raw(spark: SparkSession, view: str, root: str, schemas: Mapping[str, str]) -> None:
    """Make the raw months one relation named ``view``, for plain SQL.

    Months of one schema are the partitions of one external table, ``{view}_<digest of the schema>``; the
    view brings their columns to common types (``common_type``) and puts them together. A column that
    a month lacks is NULL there. ``schemas`` holds all months of the area with their schema as JSON. Only the catalog
    changes, no file is written, and conditions on the month reach the folders.
    """
    base = root.rstrip("/")
    alike: dict[str, list[str]] = {}
    for month, schema in schemas.items():
        alike.setdefault(schema, []).append(month)
    kinds = {schema: StructType.fromJson(json.loads(schema)) for schema in alike}
    types: dict[str, DataType] = {}
    for schema in kinds.values():
        for field in schema.fields:
            types[field.name] = common_type(types.get(field.name, field.dataType), field.dataType)
    parts = []
    for schema, months in sorted(alike.items()):
        table = f"{view}_{hashlib.sha256(schema.encode()).hexdigest()[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds[schema].fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load_month STRING) USING parquet PARTITIONED BY (load_month) LOCATION '{base}/{TABLES}'")
        known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for month in sorted(set(months) - known):
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (load_month = '{month}') LOCATION '{base}/load_month={month}'")
        spark.catalog.refreshTable(table)
        have = set(kinds[schema].names)
        chosen = ", ".join(f"CAST({f'`{n}`' if n in have else 'NULL'} AS {t.simpleString()}) AS `{n}`" for n, t in types.items())
        named = ", ".join(f"'{month}'" for month in sorted(months))
        # a month that was read again with another schema is a partition of two tables, and counts in one
        parts.append(f"SELECT {chosen}, load_month FROM {table} WHERE load_month IN ({named})")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(parts)}")


def lineage_of(spark: SparkSession, root: str) -> DataFrame:
    """Only the lineage columns of the whole raw area, whatever else its files hold."""
    return spark.read.schema(
        "_source_file string, _ingested_at timestamp, _batch_id string, load_month string"
    ).parquet(root)


def batches(raw: DataFrame) -> DataFrame:
    """When each batch of each month was ingested, and how many rows it brought."""
    return (
        raw.groupBy("load_month", "_batch_id")
        .agg(F.min("_ingested_at").alias("ingerido_em"), F.count(F.lit(1)).alias("linhas"))
        .orderBy("load_month", "_batch_id")
    )
