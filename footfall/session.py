"""Session settings and the shared folder used for work files."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Times in the data are wall-clock values without a zone; UTC keeps any
    # zone-aware value that meets them unambiguous.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: merges small shuffle partitions, splits skewed join
    # and rebalance partitions, turns measured-small join sides into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Sides estimated or measured below this are broadcast; larger ones are
    # shuffled, and hashed instead of sorted where every partition's share of
    # the smaller side is measured below the second limit.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Only the day partitions present in a written frame are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpointed results go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


MIB = 1 << 20


def size_settings(data_bytes: int, cores: int) -> dict[str, str]:
    """Split sizes for jobs that read about ``data_bytes`` on ``cores``.

    Adaptive execution merges shuffle partitions that turn out small but never
    adds any, so their number starts from the data: one per 512 MiB read, at
    least two per core. Scans take larger splits on larger data, which keeps the
    number of shuffle blocks (tasks times partitions) in bounds.
    """
    partitions = max(2 * cores, math.ceil(data_bytes / (512 * MIB)))
    split = max(128 * MIB, min(512 * MIB, data_bytes // (50 * cores)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; ``settings`` (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = SETTINGS | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name every executor can reach.

    It lies below ``spark.checkpoint.dir``. Where that is unset a temporary
    folder is used, which is only right when driver and executors share one
    machine, so any other master is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="footfall-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a folder if the session has none yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(spark, "checkpoint"))
