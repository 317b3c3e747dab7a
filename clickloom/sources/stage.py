"""Stage boundaries: write a table to the shared folder and read it back.

A staged table cuts lineage, survives the loss of executors, keeps column pruning, and gives
the planner real file sizes to choose join strategies by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows that keep a task of an iterative fit busy for some 30 ms a pass, more than it takes to start one.
ROWS_A_TASK = 1 << 16


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and all is one machine."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not is_one_machine(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return context.getCheckpointDir().rstrip("/")


def is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def new_path(spark: SparkSession, label: str = "stage") -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet once and return a frame that reads it."""
    path = new_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share rows out evenly where a few input splits would leave cores idle during heavy row work.

    Inputs of at least as many files as the cluster has cores pass unchanged. The files are counted by name: no
    stage of the plan runs for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out over as many partitions as the input has files, at least one a core.

    For a few days of a log that is stored by time: they lie in few of its files, so ``spread``, which counts these, lets
    them pass, and whatever reads the stored days has as few tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, len(df.inputFiles())))


def packed(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """All rows in no more tasks than they keep busy, for fits that pass over them thousands of times.

    A pass over few rows is mostly the start of its tasks; with more rows than that there are as many tasks as ``dealt`` has.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(max(cores, len(df.inputFiles())), max(-(-df.count() // rows_a_task), 1)))
