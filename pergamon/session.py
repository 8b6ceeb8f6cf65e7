"""Session for local runs, and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, memory="12g", **conf):
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pergamon")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The checkpoint folder the cluster names in spark.checkpoint.dir.

    Only where driver and executors are one process may it be missing: a temporary one is made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    one_process = context.master == "local" or context.master.startswith("local[")
    if not (named or context.getCheckpointDir() or one_process):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pergamon-"))
    return named or context.getCheckpointDir()


@contextmanager
def shuffle_files_removed(spark):
    """Shuffle files of frames that are made and run inside go when these have ended, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark, purpose):
    """A fresh folder name under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
