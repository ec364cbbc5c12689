"""Schemas of Parquet files as rows, read from their footers, and where they differ from a declared one."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.sources import trip_archive

# Arrow's names of the types that tables here have, and Spark's.
TYPES = {
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "bool": "boolean",
    "int32": "int",
    "int64": "bigint",
    "float": "float",
    "double": "double",
    "date32[day]": "date",
    "timestamp[us]": "timestamp_ntz",
    "timestamp[ns]": "timestamp_ntz",
    "timestamp[us, tz=UTC]": "timestamp",
    "timestamp[ns, tz=UTC]": "timestamp",
}


def file_columns(spark: SparkSession, folder: str, name_glob: str = "*.parquet") -> DataFrame:
    """A row per file and column below a folder: file, column_name, found.

    Files are listed by Spark and dealt over tasks, which read footers and nothing else. Paths are
    those that Arrow's file systems reach, as for archives.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(folder)
        .select(F.col("path").alias("file"))
    )
    uri, types = trip_archive.filesystem_uri, TYPES

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs, parquet

        for batch in batches:
            for file in batch.column(0).to_pylist():
                filesystem, path = fs.FileSystem.from_uri(uri(file))
                with filesystem.open_input_file(path) as opened:
                    found = parquet.read_schema(opened)
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [file] * len(found),
                        "column_name": found.names,
                        "found": [types.get(str(t), str(t)) for t in found.types],
                    }
                )

    return listed.repartition("file").mapInArrow(read, "file string, column_name string, found string")


def differences(files: DataFrame, table: schemas.Table) -> DataFrame:
    """Columns of files that are missing, unexpected or of another type than declared.

    Rows: file, column_name, declared (null if unexpected), found (null if missing). Folder
    keys are in no file. The declared columns are a handful, so each file is compared with a copy.
    """
    columns = [c for c in table.columns if c.name not in table.folder_keys]
    declared = F.map_from_arrays(
        F.array(*[F.lit(c.name) for c in columns]), F.array(*[F.lit(c.dtype.simpleString()) for c in columns])
    )
    found = files.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "found"))).alias("found_"))
    names = F.array_union(F.map_keys("declared_"), F.map_keys("found_"))
    pairs = found.withColumn("declared_", declared).select(
        "file", "declared_", "found_", F.explode(names).alias("column_name")
    )
    name = F.col("column_name")
    typed = pairs.select(
        "file",
        "column_name",
        F.try_element_at("declared_", name).alias("declared"),
        F.try_element_at("found_", name).alias("found"),
    )
    return typed.where(~F.col("declared").eqNullSafe(F.col("found")))
