"""Session settings and the one place where intermediate tables are written."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Paths of the tables written in the innermost open ``scratch_scope``.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def build_session(app_name: str = "tallybasket", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by driver and executors.

    ``spark.checkpoint.dir`` names it; without that setting it lies in the warehouse, which every
    session has and which a cluster shares as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    return f"{shared_dir(spark)}/tallybasket/{name}-{uuid.uuid4().hex}"


def prepare_tasks(spark: SparkSession) -> None:
    """Put the folder this package was imported from onto the import path of tasks that run Python.

    A driver may have put it onto its own path alone. On a cluster it must be there on every machine.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, lets later passes prune columns, and
    gives the planner the real size, so a join broadcasts the table only if the
    files are below ``spark.sql.autoBroadcastJoinThreshold``. The files are neither
    compressed nor dictionary-encoded, because a table that shrinks twentyfold on
    disk would pass that check and then not fit in memory.
    """
    path = scratch_path(df.sparkSession, name)
    opened = _written.get()
    if opened is not None:
        opened.append(path)
    df.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` writes in this block once it has ended, also by an error.

    For jobs whose results are written elsewhere: nothing that leaves the block may still read those tables.
    """
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
