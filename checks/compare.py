"""Runs registered queries against their SQL: python -m checks.compare [sf folder] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 10))
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty when nothing does."""
    found = QUERIES[name](spark, sf_dir)
    ours = _rows(found.columns, found.collect())
    if name not in ORACLE_SQL:
        return []
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(found.columns):
        return [f"columns {sorted(found.columns)} / {sorted(columns)}"]
    if ours == theirs:
        return []
    only_ours, only_theirs = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
    return [f"rows {len(ours)} / {len(theirs)}", f"only ours {only_ours[:3]}", f"only theirs {only_theirs[:3]}"]


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{name}: {'ok' if not found else 'DIFFERENT'} {time.time() - start:.1f}s", *found, sep="\n  ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
