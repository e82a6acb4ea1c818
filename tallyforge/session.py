"""Session settings and the few helpers that need the session itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Above this estimated size a side is never broadcast by this library.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cpus: int | str = 8, app: str = "tallyforge", **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Reads ``spark.checkpoint.dir``; a machine-local folder is made only where
    the setting is absent and the master is local.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallyforge-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)  # made here, so removed here
    context.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job is run)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def small_enough_to_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the size estimate allows it.

    Beyond the limit the frame is returned unchanged, so the join falls back
    to a shuffle join that adaptive execution can split on skewed keys.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if small_enough_to_broadcast(df, limit) else df
