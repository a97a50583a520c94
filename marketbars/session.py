"""Session settings: sized for a cluster, and a small local one.

The local session serves tests, the check and the bench. On a cluster the
session comes from its own configuration, with ``spark.checkpoint.dir`` on
shared storage and the settings of ``cluster_conf``.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession


MB = 1024 * 1024


def cluster_conf(shuffled_bytes: int, partition_mb: int = 512) -> dict[str, str]:
    """Settings for jobs whose largest shuffle carries about ``shuffled_bytes``.

    A fixed count of 200 shuffle partitions would put half a terabyte in each
    at 100 TB. These start from partitions that fit a task and spill little;
    adaptive execution then merges small ones and splits skewed join sides.
    """
    partitions = max(200, math.ceil(shuffled_bytes / (partition_mb * MB)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb // 2}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.speculation": "true",
    }


def local_session(name: str, cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count() or 4
    scratch = tempfile.mkdtemp(prefix=f"marketbars-{name}-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(f"marketbars-{name}")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
