"""Files that tasks write and read themselves, below the shared folder.

Any store that Arrow's file systems open will do (local and mounted folders,
object stores, HDFS with its client library). A task writes under a name of its
own attempt and reports it in its result row; only reported files count, so a
retried or speculative attempt leaves nothing but an unread file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark import TaskContext


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def writer(uri: str):
    """An output stream to ``uri``; its folder is made if the store has folders."""
    fs, path = opened(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None, buffer_size=1 << 20)


def reader(uri: str):
    """A random-access file."""
    fs, path = opened(uri)
    return fs.open_input_file(path)


def attempt_name() -> tuple[int, str]:
    """This task's partition and a name that no other attempt has."""
    part = TaskContext.get().partitionId()
    return part, f"part-{part:05d}-{uuid.uuid4().hex}"


def mapped(uri: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where it is a local file, else read."""
    fs, path = opened(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        size = fs.get_file_info(path).size
        return np.memmap(path, dtype, mode="r") if size else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)
