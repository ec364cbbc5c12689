"""Run registered queries beside their SQL: python tests/compare.py [sf dir] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime().isoformat()
    return repr(value)


def table_rows(arrow) -> tuple[list[str], list[tuple], dict[str, str]]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    rows = sorted(tuple(_norm(v) for v in row) for row in zip(*columns))
    return names, rows, {n: str(arrow.schema.field(n).type) for n in names}


def differences(spark_df, db, sql: str) -> list[str]:
    names, rows, types = table_rows(spark_df.toArrow())
    other_names, other_rows, other_types = table_rows(db.execute(sql).to_arrow_table())
    found = []
    if names != other_names:
        found.append(f"columns {names} / {other_names}")
    elif types != other_types:
        found += [f"type {n}: {types[n]} / {other_types[n]}" for n in names if types[n] != other_types[n]]
    if len(rows) != len(other_rows):
        found.append(f"row count {len(rows)} / {len(other_rows)}")
    elif names == other_names:
        bad = [(a, b) for a, b in zip(rows, other_rows) if a != b]
        if bad:
            found.append(f"{len(bad)} rows differ, first: {bad[0][0]} / {bad[0][1]}")
    return found


if __name__ == "__main__":
    import __spark_entry__ as contract
    from spokeline import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        session.builder("compare")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("SESSION_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(sf), contract.oracle_sql()
    wanted = sys.argv[2:] or list(contract.queries())
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            df = contract.queries()[name](spark, sf)
            found = differences(df, db, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - began:.2f}s {'; '.join(found)[:900]}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
