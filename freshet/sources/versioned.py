"""Parquet tables that change all at once: versions of partitions, and one pointer that readers follow.

``data/version=N/<partition>=.../`` holds what the N-th commit wrote, ``commits/N.json`` the version that then holds for
each partition, the columns, and the last batch of a stream. A commit is the renaming of its file: a job that dies
before it leaves the table as it was, and what it wrote is overwritten by the next one. There is one writer at a time;
a second one that commits the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .scratch import materialise

VERSION = "version"
Combine = Callable[[DataFrame, DataFrame], DataFrame]


class ConflictingCommit(RuntimeError):
    """Another writer has committed meanwhile; nothing of this one is in the table."""


@dataclass(frozen=True)
class State:
    seq: int = 0
    partition: str | None = None
    parts: dict[str, int] = field(default_factory=dict)
    schema: StructType | None = None
    writer: str | None = None
    batch: int | None = None


def _store(spark: SparkSession, path: str):  # noqa: ANN202
    """The path's own file system, and what makes a path of text."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _key(partition: str) -> Column:
    return F.coalesce(F.col(partition).cast("string"), F.lit(""))


def current(spark: SparkSession, path: str) -> State:
    """The state of the last commit; of a table that isn't there yet, an empty one."""
    store, place = _store(spark, path)
    found = store.globStatus(place(f"{path}/commits/[0-9]*.json"))
    numbers = [int(x.getPath().getName().removesuffix(".json")) for x in found or []]
    if not numbers:
        return State()
    text = "".join(r[0] for r in spark.read.text(f"{path}/commits/{max(numbers)}.json", wholetext=True).collect())
    said = json.loads(text)
    return State(max(numbers), said["partition"], said["parts"], StructType.fromJson(said["schema"]), said["writer"], said["batch"])


def _commit(spark: SparkSession, path: str, state: State) -> None:
    store, place = _store(spark, path)
    name, hidden = place(f"{path}/commits/{state.seq}.json"), place(f"{path}/commits/_{uuid.uuid4().hex}")
    out = store.create(hidden, True)
    out.write(bytearray(json.dumps({"partition": state.partition, "parts": state.parts, "schema": state.schema.jsonValue(), "writer": state.writer, "batch": state.batch}).encode()))
    out.close()
    if store.exists(name) or not store.rename(hidden, name):
        raise ConflictingCommit(f"commit {state.seq} of {path} is another writer's")


def _of(spark: SparkSession, path: str, state: State, parts: Collection[str] | None = None) -> DataFrame:
    """Rows of some partitions, by the versions that hold; both are literals of the scan, so that no other partition is read."""
    holds = {p: v for p, v in state.parts.items() if parts is None or p in parts}
    if not holds:
        return spark.createDataFrame([], state.schema)
    fields = [f for f in state.schema if f.name != state.partition]
    full = StructType([*fields, StructField(VERSION, LongType()), state.schema[state.partition]])
    read = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{VERSION}={v}" for v in sorted(set(holds.values()))])
    key = _key(state.partition)
    rows = read.where(key.isin(*holds) & F.concat_ws("/", VERSION, key).isin(*[f"{v}/{p}" for p, v in holds.items()]))
    return rows.select(*state.schema.names)


def read(spark: SparkSession, path: str, parts: Collection[str] | None = None) -> DataFrame:
    """The table as of its last commit, or some of its partitions (named by their text)."""
    state = current(spark, path)
    if state.schema is None:
        raise FileNotFoundError(f"{path} has no commit yet")
    return _of(spark, path, state, parts)


def _joined(old: StructType | None, new: StructType) -> StructType:
    """All columns of both; one that both have must be of one type."""
    out = {f.name: f for f in old or []}
    for f in new:
        if f.name in out and out[f.name].dataType != f.dataType:
            raise ValueError(f"{f.name} is {out[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the new rows")
        out.setdefault(f.name, f)
    return StructType([StructField(f.name, f.dataType) for f in out.values()])


def upsert(spark: SparkSession, path: str, new: DataFrame, partition: str, combine: Combine, check: Callable[[], None] | None = None, writer: str | None = None, batch: int | None = None) -> int:
    """Make each partition that ``new`` has anew from its rows so far and the new ones, as one commit; returns the number of new rows.

    ``new`` is computed once, by a write to the shared folder; ``check`` is called then and may raise, before anything is
    in the table. Only touched partitions are read. A stream's ``batch`` of a ``writer`` that is in already changes
    nothing. Columns that only one side has are null in the other's rows. No new rows are a commit that changes nothing.
    """
    state = current(spark, path)
    if writer is not None and state.writer == writer and batch is not None and state.batch is not None and batch <= state.batch:
        return 0
    if VERSION in new.columns:
        raise ValueError(f"a column can't be named {VERSION}")
    if state.partition not in (None, partition):
        raise ValueError(f"the table is partitioned by {state.partition}")
    new = materialise(new)
    if check is not None:
        check()
    counted = {r[0]: r[1] for r in new.groupBy(_key(partition)).count().collect()}
    schema, seq = _joined(state.schema, new.schema), state.seq + 1
    parts = dict(state.parts)
    if counted:
        own = State(state.seq, partition, state.parts, schema)
        content = combine(_of(spark, path, own, counted), new).select(*schema.names)
        content.hint("rebalance", F.col(partition)).write.mode("overwrite").partitionBy(partition).parquet(f"{path}/data/{VERSION}={seq}")
        parts |= dict.fromkeys(counted, seq)
    _commit(spark, path, State(seq, partition, parts, schema, writer, batch))
    return sum(counted.values())


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Delete the versions of which no partition holds any more, and older commits; returns them. Not while a reader still uses them."""
    state = current(spark, path)
    store, place = _store(spark, path)
    gone = []
    for folder, keep in ((f"{path}/data/{VERSION}=*", {*state.parts.values()}), (f"{path}/commits/[0-9]*.json", {state.seq})):
        for x in store.globStatus(place(folder)) or []:
            number = int(x.getPath().getName().removeprefix(f"{VERSION}=").removesuffix(".json"))
            if number <= state.seq and number not in keep:
                store.delete(x.getPath(), True)
                if folder.startswith(f"{path}/data"):
                    gone.append(number)
    return sorted(gone)
