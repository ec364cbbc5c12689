"""Data source for zip archives of trip CSVs: one task per archive member.

Members are decompressed as a stream and parsed in Arrow batches; nothing is
unpacked to disk and no member is held in memory. A deflate stream has no
entry points, so one member cannot be split further.

Of the fields, those of the schema that is read with are parsed; of the trips, those that
can't have started on the days asked for stay in the task that parses them. The days are
options, not filters that Spark pushes down: Spark 4.1 keeps pushed filters with the loaded frame, so
that a second query on the same frame misses the rows that the first one left out.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from spokeline import schemas

FORMAT = "trip_archive"
_ORIGIN = [StructField("archive", StringType()), StructField("member", StringType())]


def register(spark: SparkSession) -> None:
    """Make the format known. The class travels by value: executors need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TripArchiveSource)


def is_trip_member(name: str) -> bool:
    """CSV members below the archive root; no absolute or climbing paths, no hidden files."""
    parts = name.replace("\\", "/").split("/")
    return (
        name.endswith(".csv")
        and not name.startswith(("/", "\\"))
        and ":" not in parts[0]
        and not any(p == ".." or p.startswith(".") for p in parts)
    )


def filesystem_uri(folder: str) -> str:
    """The folder as Arrow's file systems name it: s3 for s3a and s3n, whole local paths."""
    scheme, mark, rest = folder.partition("://")
    if not mark:
        if folder.startswith("file:"):
            return f"file://{folder.removeprefix('file:')}"
        return f"file://{os.path.abspath(folder)}"
    known = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
    scheme = known.get(scheme, scheme)
    if scheme not in ("file", "s3", "gs", "hdfs", "abfs", "abfss"):
        raise ValueError(f"archives can't be read from {scheme}:// paths")
    return f"{scheme}://{rest}"


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(filesystem_uri(folder))


@dataclass
class Member(InputPartition):
    archive: str
    name: str


class TripArchiveSource(DataSource):
    """Options: ``path`` of the folder, ``months`` as yyyyMM separated by commas or ``*``,
    ``bad_rows`` (FAILFAST, or PERMISSIVE: what cannot be read is NULL, and the column
    ``corrupt_record`` has the record), ``unnamed`` (whether archives without a month in
    their names are allowed) and ``started`` (the first day and the one after the last, as
    yyyy-MM-dd with a comma between). A trip whose start doesn't begin with a day is always there.

    Read with a schema of some columns, only those are parsed; with FAILFAST, a bad number
    elsewhere is not noticed then.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        corrupt = [StructField(schemas.CORRUPT.name, StringType())] if self._permissive() else []
        return StructType([*schemas.CSV_FIELDS.fields, *corrupt, *_ORIGIN])

    def _permissive(self) -> bool:
        return self.options.get("bad_rows", "FAILFAST").upper() == "PERMISSIVE"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TripArchiveReader(
            self.options["path"],
            self.options.get("months", "*"),
            schema.fieldNames(),
            started=self.options.get("started"),
            permissive=self._permissive(),
            unnamed=self.options.get("unnamed", "refused") == "allowed",
        )


class TripArchiveReader(DataSourceReader):
    def __init__(
        self, folder: str, months: str, wanted: list[str], *, started: str | None, permissive: bool, unnamed: bool
    ) -> None:
        self.folder, self.permissive, self.unnamed = folder, permissive, unnamed
        self.globs = [f"{m}*.zip" if m != "*" else "*.zip" for m in months.split(",")]
        self.columns = [(f.name, f.dataType.simpleString()) for f in schemas.CSV_FIELDS]
        self.wanted, self.started = wanted, started.split(",") if started else None
        of_records = {schemas.CORRUPT.name} if permissive else set()
        unknown = set(wanted) - {n for n, _ in self.columns} - {f.name for f in _ORIGIN} - of_records
        if unknown:
            raise ValueError(f"archives have no columns {sorted(unknown)}")

    def partitions(self) -> list[Member]:
        """Members of all archives. Reads each archive's directory only, which sits at its end.

        Done on the driver: metadata of one archive a month.
        """
        from pyarrow import fs

        filesystem, root = _filesystem(self.folder)
        found = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        archives = sorted(
            f.path
            for f in found
            if f.is_file
            and any(fnmatch.fnmatchcase(posixpath.basename(f.path), g) for g in self.globs)
        )
        members = []
        for path in archives:
            with filesystem.open_input_file(path) as f, zipfile.ZipFile(f) as archive:
                members += [Member(path, n) for n in sorted(archive.namelist()) if is_trip_member(n)]
        found_in = [posixpath.basename(m.archive) for m in members]
        missing = [g for g in self.globs if not fnmatch.filter(found_in, g)]
        if missing:
            raise FileNotFoundError(f"no archived CSV files in {self.folder}: {missing}")
        unnamed = [a for a in found_in if not re.match(r"\d{6}", a)]
        if unnamed and not self.unnamed:
            raise ValueError(f"no month in the names of {unnamed[:5]}; give file_month")
        return members

    def _parsed(self) -> list[str]:
        """Fields to parse: all of them where records are to be kept, else those asked for."""
        names = [n for n, _ in self.columns]
        asked = {*self.wanted, *(["started_at"] if self.started else [])}
        # A field at least, for the number of rows.
        return names if self.permissive else [n for n in names if n in asked] or names[:1]

    def read(self, partition: Member) -> Iterator:
        import pyarrow as pa
        from pyarrow import csv

        types = {"string": pa.string(), "double": pa.float64()}
        names = [name for name, _ in self.columns]
        misfits = []  # records with too many or too few fields, since the last batch

        def keep(row) -> str:
            misfits.append(row.text)
            return "skip"

        filesystem, _ = _filesystem(self.folder)
        with (
            filesystem.open_input_file(partition.archive) as f,
            zipfile.ZipFile(f) as archive,
            archive.open(partition.name) as stream,
        ):
            header = stream.readline().decode("utf-8-sig").strip()
            if header and [c.strip().strip('"') for c in header.split(",")] != names:
                raise ValueError(f"the header of {partition.name} is not {','.join(names)}: {header}")
            try:
                batches = csv.open_csv(
                    stream,
                    read_options=csv.ReadOptions(
                        column_names=names, block_size=4 << 20
                    ),
                    parse_options=csv.ParseOptions(
                        newlines_in_values=True, invalid_row_handler=keep if self.permissive else None
                    ),
                    convert_options=csv.ConvertOptions(
                        include_columns=self._parsed(),
                        column_types={
                            n: pa.string() if self.permissive else types[t] for n, t in self.columns
                        },
                        null_values=[""],
                        strings_can_be_null=True,
                        quoted_strings_can_be_null=False,
                    ),
                )
            except pa.ArrowInvalid as error:
                if "Empty CSV" in str(error):  # a header without rows
                    return
                raise
            for batch in batches:
                if self.permissive:
                    batch, records = self._readable(batch)
                    yield self._asked(batch.append_column(schemas.CORRUPT.name, records), partition)
                    if misfits:
                        yield self._asked(self._misfits(misfits), partition)
                        misfits.clear()
                else:
                    yield self._asked(batch, partition)
            if misfits:
                yield self._asked(self._misfits(misfits), partition)

    def _asked(self, batch, partition: Member):
        """The trips that may have started on the days asked for, with the columns asked for."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.started:
            first, stop = self.started
            text = batch.column("started_at")
            dated = pc.match_substring_regex(text, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")
            day = pc.utf8_slice_codeunits(text, 0, 10)
            inside = pc.and_(pc.greater_equal(day, first), pc.less(day, stop))
            batch = batch.filter(pc.or_(pc.invert(dated), inside))
        for name, value in (("archive", posixpath.basename(partition.archive)), ("member", partition.name)):
            batch = batch.append_column(name, pa.repeat(pa.scalar(value, pa.string()), batch.num_rows))
        return batch.select(self.wanted)

    def _misfits(self, records: list[str]):
        """Rows of which nothing but the record is known."""
        import pyarrow as pa

        types = {"string": pa.string(), "double": pa.float64()}
        columns = [pa.nulls(len(records), types[kind]) for _, kind in self.columns]
        names = [*(n for n, _ in self.columns), schemas.CORRUPT.name]
        return pa.RecordBatch.from_arrays([*columns, pa.array(records, pa.string())], names=names)

    def _readable(self, batch):
        """Numbers that can be read, and the records of rows with one that can't, their fields as CSV."""
        import csv
        import io

        import numpy as np
        import pandas as pd
        import pyarrow as pa

        columns, spoiled = [], np.zeros(batch.num_rows, bool)
        for column, (_, kind) in zip(batch.columns, self.columns):
            if kind == "double":
                texts = column.to_pandas()
                values = pd.to_numeric(texts, errors="coerce")
                spoiled |= (texts.notna() & values.isna()).to_numpy()
                column = pa.array(values, pa.float64(), from_pandas=True)
            columns.append(column)
        records = [None] * batch.num_rows
        for row in np.flatnonzero(spoiled).tolist():
            line = io.StringIO()
            csv.writer(line, lineterminator="").writerow([c[row].as_py() for c in batch.columns])
            records[row] = line.getvalue()
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names), pa.array(records, pa.string())
