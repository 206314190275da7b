"""Session for local runs and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "pulsebook", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    n = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only a local master may
    fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pulsebook-")
    return f"{base.rstrip('/')}/pulsebook/{name}-{uuid.uuid4().hex}"
