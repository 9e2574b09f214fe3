"""Session set-up and the shared folder for intermediate data."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str, shuffle_bytes: int | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on; the master comes from spark-submit.

    ``shuffle_bytes`` is the expected size of the largest shuffle. Adaptive
    execution merges small shuffle partitions but never adds any, so a large
    job has to start with enough of them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.compress", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_bytes:
        partitions = max(200, math.ceil(shuffle_bytes / SHUFFLE_PARTITION_BYTES))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine alone, so there the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data that nothing will read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
