"""Session settings and the shared working folder.

Nothing here starts a cluster; ``build_session`` is for scripts and tests. Library code takes the
session it is given and reads ``spark.checkpoint.dir`` from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions, coalesces small shuffle partitions and turns a
# sort-merge join into a broadcast one only when the measured size is under the threshold.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("strata")
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, a folder in the warehouse, which executors and sessions share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_strata"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path of its own below the shared folder."""
    return f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
