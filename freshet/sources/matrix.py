"""Flat files of model matrices: 32-bit floats in little-endian order, a record of ``nc`` of them for each timestep.

A matrix is one file, or a folder whose files follow each other by name. It is read by a Python data source: partitions
are ranges of values, wherever records begin, and each is read as Arrow batches whose columns come from arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a partition, and values of a batch.
SPLIT, BATCH = 32 << 20, 1 << 20
SUFFIX = ".f4"


def _source() -> type[DataSource]:
    """The data source's class; made here, so that workers get it with the job and needn't import this library."""

    class Range(InputPartition):
        def __init__(self, path: str, first: int, last: int, before: int) -> None:
            super().__init__(None)
            self.path, self.first, self.last, self.before = path, first, last, before

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]) -> None:
            self.path, self.nc = options["path"], int(options["nc"])
            self.split, self.batch, self.whole = int(options["split"]) // 4, int(options["batch"]), options["form"] == "records"
            if self.whole:
                self.split, self.batch = (max(x // self.nc, 1) * self.nc for x in (self.split, self.batch))

        def partitions(self) -> list[InputPartition]:
            from pyarrow import fs

            files, root = fs.FileSystem.from_uri(self.path)
            found = files.get_file_info(root)
            if found.type == fs.FileType.NotFound:
                raise FileNotFoundError(self.path)
            listed = [found] if found.is_file else [f for f in files.get_file_info(fs.FileSelector(root)) if f.is_file and not f.base_name.startswith(("_", "."))]
            ranges, before = [], 0
            for f in sorted(listed, key=lambda f: f.base_name):
                if f.size % (4 * self.nc):
                    raise ValueError(f"{f.path} of {f.size} bytes hasn't whole records of {self.nc} values")
                n = f.size // 4
                ranges += [Range(f.path, a, min(a + self.split, n), before) for a in range(0, n, self.split)]
                before += n
            return ranges or [Range("", 0, 0, 0)]

        def read(self, part: Range) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            if part.first >= part.last:
                return
            files, _ = fs.FileSystem.from_uri(self.path)
            with files.open_input_file(part.path) as f:
                for a in range(part.first, part.last, self.batch):
                    n = min(self.batch, part.last - a)
                    values = np.frombuffer(f.read_at(4 * n, 4 * a), "<f4")
                    if len(values) != n:
                        raise OSError(f"{part.path} is shorter than it was")
                    at = np.arange(part.before + a, part.before + a + n, self.nc if self.whole else 1, dtype=np.int64)
                    if self.whole:
                        edges = np.arange(0, 4 * n + 1, 4 * self.nc, dtype=np.int32)
                        records = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(values)])
                        yield pa.RecordBatch.from_arrays([pa.array(at // self.nc), records], ["t", "record"])
                        continue
                    columns = [pa.array(at // self.nc), pa.array((at % self.nc).astype(np.int32)), pa.array(values.astype(float))]
                    yield pa.RecordBatch.from_arrays(columns, ["t", "position", "value"])

    class Matrix(DataSource):
        @classmethod
        def name(cls) -> str:
            return "flat_matrix"

        def schema(self) -> str:
            return "t long, record binary" if self.options["form"] == "records" else "t long, position int, value double"

        def reader(self, schema: object) -> DataSourceReader:
            return Reader(dict(self.options))

    return Matrix


def _read(spark: SparkSession, path: str, **options: int | str) -> DataFrame:
    if min(options["nc"], options["split"] // 4, options["batch"]) < 1:
        raise ValueError("a record, a partition and a batch have at least one value")
    spark.dataSource.register(_source())
    return spark.read.format("flat_matrix").options(**options).load(path)


def matrix_values(spark: SparkSession, path: str, nc: int, split: int = SPLIT, batch: int = BATCH) -> DataFrame:
    """``t, position, value`` of a matrix with ``nc`` values a timestep, in partitions of about ``split`` bytes.

    ``path`` is a URI or an absolute path, of a file or of a folder of files (names that begin with ``_`` or ``.`` don't
    count); an empty one has no rows. A file whose size isn't a whole number of records is an error.
    """
    return _read(spark, path, nc=nc, split=split, batch=batch, form="values")


def matrix_file(spark: SparkSession, path: str, nc: int, split: int = SPLIT, batch: int = BATCH) -> DataFrame:
    """``t, record`` of the same files, cut only between records."""
    return _read(spark, path, nc=nc, split=split, batch=batch, form="records")


def write_matrix(records: DataFrame, path: str) -> int:
    """Write ``t, record`` into a new folder, a file for each range of timesteps; returns how many there are.

    Timesteps must be 0, 1, 2 ... without gaps or repeats, as a flat file doesn't name them: else it raises, after the
    files are written. A file has its name only when it is complete, so that a task may run again.
    """
    suffix = SUFFIX

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        batches = (b for b in batches if b.num_rows)
        b = next(batches, None)
        if b is None:
            return
        first, n, last, gaps = b.column(0)[0].as_py(), 0, b.column(0)[0].as_py() - 1, 0
        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(root, recursive=True)
        own = f"{root}/_{uuid.uuid4().hex}"
        with files.open_output_stream(own) as out:
            while b is not None:
                t = b.column(0).to_numpy()
                gaps += int((np.diff(t, prepend=last) != 1).sum())
                n, last = n + len(t), int(t[-1])
                packed = b.column(1).cast(pa.binary())
                if packed.null_count:
                    raise ValueError("a timestep has no record")
                edges = np.frombuffer(packed.buffers()[1], "<i4")[packed.offset : packed.offset + len(t) + 1]
                if edges[-1] > edges[0]:
                    out.write(packed.buffers()[2].slice(int(edges[0]), int(edges[-1] - edges[0])))
                b = next(batches, None)
        files.move(own, f"{root}/{first:020d}{suffix}")
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, last, n, gaps)], ["first", "last", "n", "gaps"])

    ordered = records.select(F.col("t").cast("long").alias("t"), "record").repartitionByRange("t").sortWithinPartitions("t")
    done = ordered.mapInArrow(run, "first long, last long, n long, gaps long")
    total = done.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("gaps").alias("gaps")).first()
    if total.n and (total.first != 0 or total.last + 1 != total.n or total.gaps):
        raise ValueError(f"{total.n} records from {total.first} to {total.last} aren't all timesteps once")
    return total.n or 0
