"""Parquet files of the shared folder, opened inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def open_file(uri: str) -> pq.ParquetFile:
    system, path = fs.FileSystem.from_uri(uri)
    return pq.ParquetFile(path, filesystem=system)


def batches_of(folder: str) -> Iterator[pa.RecordBatch]:
    """The rows of all files in a folder, some at a time; none where there is no folder."""
    system, path = fs.FileSystem.from_uri(folder)
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if info.is_file and info.base_name.endswith(".parquet"):
            yield from pq.ParquetFile(info.path, filesystem=system).iter_batches()
