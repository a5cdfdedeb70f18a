"""Run queries next to their SQL and compare every row and type.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return f"decimal {value:f}"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, bool):
        return f"bool {value}"
    return value


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, name: str) -> str | None:
    """What differs, or None."""
    df = queries()[name](spark, folder)
    ours = bag(df.columns, df.collect())
    found = con.execute(oracle_sql()[name])
    names = [column[0] for column in found.description]
    theirs = bag(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {sum(only_ours.values())}: {list(only_ours)[:2]}; "
            f"only theirs {sum(only_theirs.values())}: {list(only_theirs)[:2]}"
        )
    return None if ours else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            wrong = difference(spark, con, folder, name)
        except Exception as error:  # one broken query must not hide the others
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{time.time() - start:6.1f}s {name}: {wrong or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
