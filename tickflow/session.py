"""Session defaults and the durable lineage cut every iterative operator uses."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "tickflow", memory: str = "8g") -> SparkSession:
    """Session for tests and single-node runs; a cluster brings its own."""
    shuffle = str(cpus) if str(cpus).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``.  A temporary folder is made only for
    ``local`` masters, where driver and executors share one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tickflow-")
    sc.setCheckpointDir(made)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    import uuid

    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The result survives lost executors and freezes anything that depends on how rows were
    partitioned (see ``ordered.range_chunks``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
