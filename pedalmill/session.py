"""Session builder and the shared-folder rule for checkpoints."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pedalmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; what the caller or spark-submit sets wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.showConsoleProgress": "false",
        # checkpoints that nothing refers to any more are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share for cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a session on this machine alone (tests, local runs) may
    leave it unset and gets a temporary folder; any other master raises, as its executors would not share one.
    """
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix=f"pedalmill-{os.getpid()}-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir() or named


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per session, so that Python functions find it wherever the session
    was started from. Not needed where it is installed or in a shared folder on their path."""
    root = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory() as folder:
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "pedalmill"), "zip", os.path.dirname(root), os.path.basename(root)))


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint, which survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input is in fewer pieces than there are cores, else as it is.

    For costly row-by-row work on small inputs: then their rows cost less to move than to wait for. The
    number of pieces is known from the plan; no job runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
