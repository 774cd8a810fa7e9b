"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs count on. A cluster may already set them; they are runtime
# settings, so `configure` can apply them to a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on a natural key may meet a key that holds a large share of all
    # rows; AQE splits such a partition and replays the other side against it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The `rebalance` hint in front of the fact write relies on this one to
    # split a hot date over many tasks.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_checked_sums(spark: SparkSession) -> None:
    """Sums of cents that overflow must end a load, which they do in ANSI mode only."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled, or call tillmart.session.configure")


def local_session(cores: str = "8", app: str = "tillmart") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # The default lists a table of many dates with one task per folder.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """New folder below the shared folder named by ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is made only for a
    local master where the setting is missing.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")
