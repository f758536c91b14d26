"""Session helpers shared by every operator."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
#: Rows of an Arrow batch: a batch of very long texts must still fit a Python worker.
ARROW_ROWS = 256
#: Bytes of an Arrow batch, for the same reason.
ARROW_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of a data folder, through Spark's own readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that pickled functions can be imported there.

    Spark's file server carries the archive; nothing relies on a folder that driver and executors share.
    """
    context = spark.sparkContext
    if getattr(context, "_sagaframe_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="sagaframe-")
    target = os.path.join(folder, "sagaframe.zip")
    root = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for where, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith((".py", ".json")):
                    path = os.path.join(where, name)
                    archive.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    context._sagaframe_shipped = True


def prepare(spark: SparkSession) -> None:
    """What an operator with Python code needs: the package on the executors and bounded Arrow batches."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where the session names none (tests)."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if not folder:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sagaframe-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there: survives lost executors, computed once."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def free(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files and checkpoints of frames that are no longer held; else they stay until the driver's heap fills up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out only where the input has fewer partitions than the session has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
