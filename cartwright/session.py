"""SparkSession defaults for every job in the package.

Only settings a Spark user would set for these jobs: UTC days (the
reference truncates timestamps to UTC dates), adaptive execution with
skew-join splitting, and no web UI. The checkpoint folder is read from the
session; a local scratch folder is chosen only when the session runs in
local mode and nothing is configured (tests, the bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition is "skewed" at 4x the median and >= 64 MB; AQE then splits it
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # broadcast only what the planner estimates below 32 MB; AQE re-checks
    # with runtime sizes and falls back to sort-merge beyond it
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "cartwright",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``shuffle_partitions`` should be sized so a shuffle partition holds
    roughly 64-128 MB at the target scale; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # session-level SQL confs also apply when getOrCreate returned an
    # existing session
    for k, v in conf.items():
        if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``). Only a local-mode
    session without a setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running on a cluster")
    path = tempfile.mkdtemp(prefix="cartwright-ckpt-")
    sc.setCheckpointDir(path)
    return path


def warehouse_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint root, for written model tables."""
    root = checkpoint_root(spark)
    return "/".join([root.rstrip("/"), "cartwright", *parts])


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects, for any store that Spark reads."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Files at this path go when the driver ends."""
    fs, target = file_system(spark, path)
    fs.deleteOnExit(target)


def recommended_conf(input_bytes: int, cores: int, target_bytes: int = 128 << 20,
                     most_shuffle: int | None = None) -> dict:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` task slots.

    Scan splits: the input over two waves of tasks, between 1 MB and
    ``target_bytes`` (128 MB on a cluster). Shuffle partitions: one per
    512 MB of input (shuffles carry projected, partially aggregated columns,
    a fraction of the input), at least 2 per core; AQE coalesces small ones
    and splits skewed ones. The count follows the input without an upper limit
    unless ``most_shuffle`` sets one (where map x reduce blocks become too
    many). E.g. 100 TB on 8,000 cores: 128 MB splits and some 195,000 shuffle
    partitions; sf0.1 on 8 cores: ~2.3 MB splits, 16 partitions.
    """
    if input_bytes <= 0:
        raise ValueError("the size of the input must be known")
    split = int(min(target_bytes, max(1 << 20, input_bytes // max(1, 2 * cores))))
    shuffle = int(max(2 * cores, -(-input_bytes // (512 << 20))))
    shuffle = min(shuffle, most_shuffle) if most_shuffle else shuffle
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.files.openCostInBytes": str(min(split, 4 << 20)),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_bytes, max(1 << 20, split))),
    }


def input_size(path: str, spark: SparkSession | None = None) -> int:
    """Bytes below a folder; of any file system with a session, of a local one without.

    Raises FileNotFoundError if there is nothing to measure, so that no job is
    sized for an input that it cannot see.
    """
    if spark is not None:
        sc = spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
        total = fs.getContentSummary(target).getLength() if fs.exists(target) else 0
    elif "://" in path:
        raise ValueError("pass a session to measure a folder of another file system")
    else:
        total = sum(os.path.getsize(os.path.join(folder, f))
                    for folder, _, files in os.walk(path) for f in files)
    if not total:
        raise FileNotFoundError(f"nothing to measure at {path}")
    return total
