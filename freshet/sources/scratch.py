"""Tables of a run in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that isn't set, as in tests, below a temporary one.

    Only a local master may go without the setting: elsewhere executors and driver don't share temporary folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if "dir" not in _own:
            _own["dir"] = tempfile.mkdtemp(prefix="freshet-")
            atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
        base = "file://" + _own["dir"]
    return f"{base.rstrip('/')}/freshet-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a table once and read it again: its lineage ends there and its readers share the work."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
