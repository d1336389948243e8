"""Session for tests and bench runs, and the shared scratch folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A local session; a cluster brings its own and never calls this."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("railpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Joins whose small side fits per partition, as measured, hash instead of sorting.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster shares (``spark.checkpoint.dir``).

    A local master may do without that setting and gets a temporary folder; on a cluster
    each machine would write to its own disk, so there its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        base = tempfile.mkdtemp(prefix="railpulse-")
    return f"{base.rstrip('/')}/railpulse-{purpose}-{uuid.uuid4().hex}"
