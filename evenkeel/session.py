"""Session helpers: a local session for tests and a place for scratch tables."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    partitions: int = 8,
    memory: str = "4g",
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A local session with the settings the tests and the bench rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("evenkeel")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="evenkeel-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
