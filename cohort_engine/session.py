"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregation by patient that follows a join by patient reuses the join's
    # partitioning. Without this, AQE then leaves a skewed join unsplit, because
    # splitting it costs one more shuffle (of partial aggregates only).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive skew handling that the joins here count on."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A new path for intermediate tables, deleted when the session's process ends.

    It is below ``spark.checkpoint.dir``, the folder that all executors of a cluster
    share; without that setting below the warehouse. Raises if that is a local folder while
    executors run on other machines.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        one_machine = re.fullmatch(r"local(\[[^\[\]]*\])?", context.master)
        if not one_machine and re.match(r"file:|/", root):
            raise ValueError(
                f"executors do not share {root!r}: set spark.checkpoint.dir to a folder they share"
            )
    folder = f"{root.rstrip('/')}/scratch-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{prefix}-{uuid.uuid4().hex}"
