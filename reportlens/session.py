"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partition count that keeps one partition near ``partition_bytes``.

    Never below the number of cores. AQE merges what turns out too small, so a generous
    ``shuffle_bytes`` estimate costs little.
    """
    return max(cores, -(-shuffle_bytes // partition_bytes))


def settings(shuffle_bytes: int = 0, cores: int = 8) -> dict[str, str]:
    """Spark settings the jobs rely on; everything else stays at Spark's defaults."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes, cores)),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def local_session(cores: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("reportlens")
    conf = {
        **settings(cores=cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to this machine's temporary folder: on a cluster the
    executors would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{tempfile.gettempdir()}/reportlens-scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/reportlens/{label}-{uuid.uuid4().hex}"
