"""Intermediates that outlive a lost executor: parquet tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``.

    A local session that names no such folder gets one beside its warehouse; any other session without one raises, as a
    folder of one machine would lose the files for the others.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediates"
        _ROOTS[app] = f"{named.rstrip('/')}/linkscout-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(remove, spark, _ROOTS[app], True)
    return _ROOTS[app]


def new_folder(spark: SparkSession, name: str = "table") -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Delete a folder through the file system that holds it. At exit, a session that has ended already is left alone."""
    if at_exit and spark.sparkContext._jsc is None:
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate once and read it back, so that no later stage computes again what led to it."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    """The same, with aggregates over all rows, which the write itself observes: they cost no pass of their own."""
    seen = Observation()
    written = materialise(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]))
    return written, seen.get


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """A written intermediate with its number of rows."""
    written, seen = observed(df, {"n": F.count(F.lit(1))})
    return written, seen["n"]


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """All intermediates written inside the block go to one folder, which is deleted when the block ends."""
    app, path = spark.sparkContext.applicationId, new_folder(spark, "run")
    before, _ROOTS[app] = _ROOTS[app], path
    try:
        yield path
    finally:
        _ROOTS[app] = before
        remove(spark, path)
