"""Written tables that cut lineage and survive the loss of an executor.

Tables land under the folder the cluster names in ``spark.checkpoint.dir``. Only a local session
without that setting falls back to a temporary folder of its own; a cluster must name one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_noted: list[list[Scratch]] = []


@contextmanager
def dropped_after() -> Iterator[None]:
    """Drops every folder of written tables that is opened inside, once the block is done.

    Put it around steps whose results are stored elsewhere by then.
    """
    _noted.append([])
    try:
        yield
    finally:
        for scratch in _noted.pop():
            scratch.drop()


@contextmanager
def measured_joins(*sessions: SparkSession) -> Iterator[None]:
    """Joins planned inside are broadcast by the measured size of a side, within the limit of the session.

    Columns that repeat take hardly any room in files, so the size of a written table says little about its rows: millions
    may pass for a few megabytes and would be gathered by the driver. The settings are as before once the block is done.
    """
    by_files, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    changed: list[tuple[SparkSession, str, str | None]] = []
    try:
        for spark in sessions:
            limit = spark.conf.get(by_files)
            if spark.conf.get(measured, None) is None:
                changed.append((spark, measured, None))
                spark.conf.set(measured, limit)
            changed.append((spark, by_files, limit))
            spark.conf.set(by_files, "-1")
        yield
    finally:
        for spark, key, value in reversed(changed):
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _local_root[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_root[app]


class Scratch:
    """One folder of written tables for one call; drop() removes it once results are stored."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        if _noted:
            _noted[-1].append(self)

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:04d}-{label}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
