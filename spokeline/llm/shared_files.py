"""Files in shared folders, and this package for executors that have no copy of it."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from spokeline.session import scratch_root

_shipped: set[str] = set()


def write_file(folder: str, name: str, data: bytes) -> None:
    """Write a file in a shared folder; it is there whole or not at all."""
    url = urlparse(folder)
    if url.scheme in ("", "file"):
        os.makedirs(url.path, exist_ok=True)
        part = os.path.join(url.path, f".{name}.{uuid.uuid4().hex}")
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, os.path.join(url.path, name))
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as f:
        f.write(data)


def ship(spark: SparkSession) -> None:
    """Send this package to all executors, once per application.

    Functions that run in Python workers are known there by name.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    folder, name = scratch_root(spark), f"{root.name}-{uuid.uuid4().hex}.zip"
    write_file(folder, name, packed.getvalue())
    context.addPyFile(f"{folder}/{name}")
    _shipped.add(context.applicationId)
