"""Sessions and the few settings that the operators read from them."""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import is_remote


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docaudit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, unless they find it by themselves."""
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    context = spark.sparkContext
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.applicationId in _SHIPPED or not os.path.isdir(package) or root in map(os.path.abspath, known) or (context.master.startswith("local[") and os.getcwd() == root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="docaudit-ship-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith((".py", ".npz")):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    sys.path[:] = [p for p in sys.path if p != path]  # the driver keeps its own files
    _SHIPPED.add(context.applicationId)


def shared_checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` in the folder that all executors share.

    The folder is the one in ``spark.checkpoint.dir``. Only where that is unset and all runs in this one
    process (``local[n]``), as in tests, a temporary folder takes its place, removed at the end.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="docaudit-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if it is read in fewer parts than there are cores: a small input for costly work per row.

    For frames that are read, filtered and projected only: the parts of others are known when they have run.
    Inputs of more parts, so all large ones, stay where they are.
    """
    if is_remote():  # a client does not see the parts
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
