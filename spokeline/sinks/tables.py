"""Partitioned Parquet tables and their ways to be replaced.

* replace: the table becomes exactly the new rows;
* replace by key: folders that get new rows are replaced, others stay;
* replace window: all folders of a date window are replaced, those without
  new rows disappear;
* replace sources: all folders of the files the new rows came from are replaced.

Every write is idempotent, and a write that fails leaves the stored rows as they
were. Spark moves new files into place only when all tasks are done, so a lost
executor repeats its tasks and never leaves half a folder; old folders and files
go after that. A run that stops in between is completed by running it again.

A table that is replaced as a whole is written as a version of its own, a folder
inside the table's. The file ``_current`` names the version that counts and is
switched in one step, so that a reader finds the old rows or the new ones and
never none. The version before stays for readers that are still at work on it, until the
table is replaced again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spokeline import files, schemas
from spokeline.sources.tables import CURRENT, VERSION, current


class EmptyWindowError(ValueError):
    """The source holds no row for a window that was to be replaced."""


def laid_out(df: DataFrame, table: schemas.Table, *, gather: bool = True, counts: list[Column] | None = None, seen=None):
    """Rows in the table's column order, grouped by folder and sorted inside files.

    ``gather`` brings the rows of a folder together with a rebalance, which
    adaptive execution splits where a folder is larger than the advisory
    partition size: one day may hold most rows and still be written by many
    tasks. Leave it out when the input is already stored by the same key.

    ``counts`` are noted in ``seen`` behind the rebalance, in the tasks that write: Spark adds
    the notes of a finished task of the last stage once, however often tasks are repeated.
    """
    rows = df.select(*table.names)
    if gather:
        rows = rows.hint("rebalance", *table.folder_keys)
    if seen is not None:
        rows = rows.observe(seen, *counts)
    order = [*table.folder_keys, *table.cluster_by]
    return rows.sortWithinPartitions(*order) if order else rows


def _write_folders(rows: DataFrame, path: str, table: schemas.Table) -> set[str]:
    """Replace the folders that get rows, and return their names, as in ``started_date=2024-01-31``."""
    keys = table.folder_keys
    # Folders are noted while they are written. The note is
    # taken last in the plan, where an empty input does not remove it.
    seen = Observation(f"{table.name} folders")
    name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    rows = rows.observe(seen, F.array_join(F.collect_set(name), ",").alias("keys"))
    (
        rows.write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return {k for k in (seen.get["keys"] or "").split(",") if k}


def replace(df: DataFrame, path: str, table: schemas.Table, *, gather: bool = True, counts=None, seen=None) -> None:
    """Make the table exactly the new rows, in one step once they are written."""
    spark = df.sparkSession
    before = current(spark, path)
    version = f"{VERSION}{uuid.uuid4().hex}"
    rows = laid_out(df, table, gather=gather, counts=counts, seen=seen)
    writer = rows.write.option("compression", "zstd")
    if table.folder_keys:
        writer = writer.partitionBy(*table.folder_keys)
    writer.parquet(f"{path}/{version}")
    files.put_text(spark, f"{path}/{CURRENT}", version)
    # What no reader can have found since the last switch goes.
    kept = {version, before.removeprefix(f"{path}/"), CURRENT}
    for name in files.names(spark, path):
        if name not in kept and (before != path or name.startswith(VERSION)):
            files.delete(spark, f"{path}/{name}")


def replace_by_key(df: DataFrame, path: str, table: schemas.Table, *, gather: bool = True) -> None:
    """Replace the folders the new rows belong to."""
    _write_folders(laid_out(df, table, gather=gather), current(df.sparkSession, path), table)


def replace_sources(df: DataFrame, path: str, table: schemas.Table) -> None:
    """Replace all that files brought before by what they bring now.

    The last folder key names the file, or its month. Folders of a file that it brings no more
    rows for are dropped. Rows stay in the tasks that read them: no shuffle.
    """
    spark = df.sparkSession
    written = _write_folders(laid_out(df, table, gather=False), path, table)
    brought = {w.rsplit("/", 1)[-1] for w in written}
    folders = [""]
    for _ in table.folder_keys:
        folders = [f"{f}/{n}".lstrip("/") for f in folders for n in files.names(spark, f"{path}/{f}") if "=" in n]
    for folder in folders:
        if folder.rsplit("/", 1)[-1] in brought and folder not in written:
            files.delete(spark, f"{path}/{folder}")


def replace_window(
    df: DataFrame,
    path: str,
    table: schemas.Table,
    window: tuple[date, date],
    *,
    allow_empty: bool = False,
    gather: bool = True,
    counts: list[Column] | None = None,
    seen: Observation | None = None,
) -> int:
    """Replace every day of a half-open window and return how many days got rows.

    New days are written first and stale days dropped afterwards. Unless
    ``allow_empty``, no day is dropped if the window got no row at all, or if one
    of its months has stored days and got no row: a source that is missing, in
    whole or for a month, does not erase history.
    """
    first, stop = window
    spark, key = df.sparkSession, table.partition_by
    path = current(spark, path)
    inside = df.where((F.col(key) >= F.lit(first)) & (F.col(key) < F.lit(stop)))
    rows = laid_out(inside, table, gather=gather, counts=counts, seen=seen)
    written = {w.removeprefix(f"{key}=") for w in _write_folders(rows, path, table)}
    stored = [d for d in stored_keys(spark, path, key) if str(first) <= d < str(stop)]
    if not allow_empty:
        if not written:
            raise EmptyWindowError(f"no rows for {first} up to {stop}; nothing was replaced")
        lost = sorted({d[:7] for d in stored} - {d[:7] for d in written})
        if lost:
            raise EmptyWindowError(f"no rows for {', '.join(lost)}, which are stored; no day was dropped")
    for day in stored:
        if day not in written:
            files.delete(spark, f"{path}/{key}={day}")
    return len(written)


def stored_keys(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values a table has a folder for, from the file system's listing alone."""
    names = files.names(spark, current(spark, path))
    values = [n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}=")]
    return [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
