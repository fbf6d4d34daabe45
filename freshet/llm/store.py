"""Files in the shared folder, written and read from inside tasks."""

from __future__ import annotations

from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tasks that read files back at most.
READERS = 1 << 16


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; ``file:``, ``hdfs:``, ``s3:`` and ``gs:`` are what pyarrow opens by itself."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str, name: str):
    """A stream whose file gets its name when it is complete, so that a lost attempt leaves none under that name."""
    system, path = open_store(uri)
    system.create_dir(path, recursive=True)
    context = TaskContext.get()
    attempt = context.taskAttemptId() if context else 0
    hidden = f"{path}/_{name}.{attempt}"
    with system.open_output_stream(hidden) as out:
        yield out
    system.move(hidden, f"{path}/{name}")


def partition_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def dealt(files: DataFrame, name: str) -> DataFrame:
    """Rows that name a file each in as many partitions as there are files, in order of the names.

    With a given number, adaptive execution leaves the few short rows apart.
    """
    return files.repartitionByRange(max(1, min(READERS, files.count())), name)
