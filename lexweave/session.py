"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lexweave")
    settings = {**SESSION_DEFAULTS, "spark.sql.shuffle.partitions": cores, **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a
    cluster the other executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="lexweave-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")
