"""Binary files in the shared folder, written and range-read by tasks.

Tasks reach the folder through ``pyarrow.fs`` (local or mounted paths, object
stores, HDFS where its client library is installed). A task writes under a
fresh name and reports the name in its output rows; readers open only reported
files, so what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from ..session import scratch_path


def shared_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def tasks_for(size: int | None, task_bytes: int = 32 << 20) -> int:
    """Tasks that read ``size`` bytes of files. Rows that only name a range of a
    file are small, so the number is given where they are dealt out: AQE would
    join partitions by the size of the names."""
    return max(1, -(-(size or 0) // task_bytes))


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """(uri, open output stream) of a fresh file."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = _at(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path)


def open_for_ranges(uri: str) -> pa.NativeFile:
    system, path = _at(uri)
    return system.open_input_file(path)
