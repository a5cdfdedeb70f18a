"""What has landed and what has been taken: a ledger of files, month by month.

A month is the set of files that lie in the landing area under its name. The ledger holds path, time,
size and schema of the files each raw month was made of. A month whose files are not those of the ledger is read
again as a whole and replaces its raw folder, so a file that lands again, under its old name or
another one, replaces what it brought before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.guards import insist
from ..functions.types import common_type
from .landing import FILE_MONTH, schema_text

LEDGER = "_ledger"  #: folder of the ledger in the raw area; readers of the area pass over it
_ENTRY = "path string, modified timestamp, size long, batch_id string, schema string, load_month string"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """``path, modified, size, load_month`` of all Parquet files below ``landing``; only their names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(landing)
    month = F.regexp_extract("path", FILE_MONTH, 1).alias("load_month")
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), month)


def ledger(spark: SparkSession, raw_root: str) -> DataFrame:
    """The entries of all raw months."""
    place = f"{raw_root.rstrip('/')}/{LEDGER}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).parquet(place)


def changed_months(files: DataFrame, entries: DataFrame) -> list[str]:
    """Months with a file that the ledger does not have like this. Files that are only gone change nothing."""
    key = ["load_month", "path", "modified", "size"]
    new = files.select(*key).join(entries.select(*key), key, "left_anti")
    # as many rows as there are months
    return sorted(r["load_month"] for r in new.select("load_month").distinct().collect())


def _schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by schema. One job merges their footers; only where types differ is each asked for its own."""
    try:
        return {schema_text(spark.read.option("mergeSchema", True).parquet(*paths)): list(paths)}
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    found: dict[str, list[str]] = {}
    for path in paths:
        found.setdefault(schema_text(spark.read.parquet(path)), []).append(path)
    return found


def read_files(spark: SparkSession, paths: Sequence[str], wanted: StructType | None = None) -> DataFrame:
    """The rows of Parquet files whose schemas may differ.

    A column that some files lack is NULL in their rows. One that has several types gets the narrowest
    type that holds them all (``common_type``). Columns of ``wanted`` that no file has are added as NULL;
    a file's columns beyond ``wanted`` stay.
    """
    by_schema = _schemas(spark, paths)
    schemas = {text: StructType.fromJson(json.loads(text)) for text in by_schema}
    types = {f.name: f.dataType for f in wanted.fields} if wanted else {}
    for schema in schemas.values():
        for field in schema.fields:
            known = types.get(field.name)
            types[field.name] = field.dataType if known is None else common_type(known, field.dataType)
    parts = []
    for text, schema in schemas.items():
        rows = spark.read.schema(schema).parquet(*by_schema[text])
        have = set(schema.names)
        columns = [(F.col(f"`{name}`") if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in types.items()]
        parts.append(rows.select(*columns, F.col("_metadata.file_path").alias("_source_file")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def take_months(
    spark: SparkSession, landing: str, raw_root: str, months: Sequence[str], schema: StructType | None = None
) -> None:
    """Read ``months`` from their files, replace their raw folders, and then enter them in the ledger.

    A run that stops before the entry is repeated by the next one, with the same outcome.
    """
    files = landed_files(spark, landing)
    root = raw_root.rstrip("/")
    for month in months:
        # as many rows as the month has files
        mine = files.where(F.col("load_month") == month).orderBy("path").collect()
        batch = str(uuid.uuid4())
        rows = read_files(spark, [r["path"] for r in mine], schema)
        rows = rows.withColumns({"_ingested_at": F.current_timestamp(), "_batch_id": F.lit(batch)})
        rows.write.mode("overwrite").parquet(f"{root}/load_month={month}")
        entries = [(r["path"], r["modified"], r["size"], batch, schema_text(rows), month) for r in mine]
        entered = spark.createDataFrame(entries, _ENTRY).coalesce(1).write.partitionBy("load_month").mode("overwrite")
        entered.option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{LEDGER}")


def ingest_landed(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    schema: StructType | None = None,
    months: Sequence[str] | None = None,
) -> list[str]:
    """Take every month whose files are not those of the ledger; returns these months.

    With ``months`` only these are looked at. A file without a month in its name stops the run.
    """
    files = landed_files(spark, landing)
    files = insist(files, F.col("load_month") != "", "landed file without a month in its name")
    if months is not None:
        files = files.where(F.col("load_month").isin(*months))
    changed = changed_months(files, ledger(spark, raw_root))
    take_months(spark, landing, raw_root, changed, schema)
    return changed


def recorded_schemas(spark: SparkSession, raw_root: str, months: Sequence[str]) -> dict[str, str]:
    """The schema of each raw month, as JSON."""
    entries = ledger(spark, raw_root).where(F.col("load_month").isin(*months))
    return {r["load_month"]: r["schema"] for r in entries.groupBy("load_month").agg(F.first("schema").alias("schema")).collect()}
