"""Session helpers: local sessions for tests and bench, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


class _Stages(threading.local):
    """Tables of this thread: a stream's batches don't count or drop those of other jobs."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_stages = _Stages()


def local_session(cpus: str | int = 8, app: str = "affinis", memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a scratch one only for local sessions."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if sc.getCheckpointDir() is None:
        if configured is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="affinis-checkpoint-")
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


def cut_lineage(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and continue from that table.

    The copy lives in shared storage, so losing an executor does not lose it, and later
    steps read only the columns and partitions they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    _stages.paths.append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the executors, once per application.

    Functions that run in tasks are found there by import, so executors need the package
    even if only the driver has it on its path.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="affinis-"), "affinis.zip")  # the driver serves it
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("affinis", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def drop_stages(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables that ``cut_lineage`` of this thread wrote; returns their number.

    ``since`` keeps the first ones: pass the ``stage_count()`` from before a job. Results that
    still read the tables must have been written or collected before.
    """
    sc, n = spark.sparkContext, len(_stages.paths) - since
    while len(_stages.paths) > since:
        path = sc._jvm.org.apache.hadoop.fs.Path(_stages.paths.pop())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    return n


def stage_count() -> int:
    return len(_stages.paths)


def fix_partitions(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` so that partition numbers and the order inside them stay fixed."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
