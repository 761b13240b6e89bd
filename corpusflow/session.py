"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table an operator broadcasts on its own measurement.
BROADCAST_BYTES = 256 * 1024 * 1024
# Generous size of one row of a class table (label and a few numbers).
CLASS_ROW_BYTES = 256
# What this process stages lies in one folder of its own.
_RUN = uuid.uuid4().hex


def build_session(app: str = "corpusflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partition counts are left to the cluster: set
    ``spark.sql.shuffle.partitions`` high there and let AQE merge small ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is named, a session with a ``local`` master (a laptop, a test) gets
    a temporary folder. On any other master that would be a folder which only the
    driver has, so it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if root is None and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="corpusflow-"))
    return root or context.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{work_root(spark).rstrip('/')}/corpusflow/{_RUN}/{label}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete all that this process has staged so far.

    For the end of a flow: results that are still to be read from staged tables
    have to be written elsewhere first.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{work_root(spark).rstrip('/')}/corpusflow/{_RUN}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fix_rows(df: DataFrame) -> DataFrame:
    """Checkpoint on reliable storage; partitions and row order stay as they are."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, size_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a table whose measured size is within the limit, else the table as it is."""
    return F.broadcast(df) if size_bytes <= limit else df


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table once to the shared folder, with the writer's ``options``, and read it back.

    Cuts the lineage, and lets Catalyst see the table's size on disk: a later
    join broadcasts it only if it is below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
