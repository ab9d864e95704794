"""Session construction and the shared work folder.

Every tuning value is a parameter.  The defaults pin what results depend on
(UTC calendar, ANSI arithmetic) and switch on adaptive execution so that
shuffle partitions are coalesced, skewed join partitions are split and
rebalance hints are honoured at run time.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every session built here gets unless the caller overrides them.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Small results (a daily aggregate written as thousands of day folders) still
    # spread over every core: AQE otherwise merges anything under 1 MiB into
    # one task, which then creates every file one after another.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
}


MIB = 1024 * 1024


def scale_conf(
    input_bytes: int,
    shuffle_partition_bytes: int = 256 * MIB,
    scan_split_bytes: int = 256 * MIB,
) -> dict[str, str]:
    """Partition sizing for a job that reads about ``input_bytes``.

    * ``spark.sql.shuffle.partitions``: enough that a shuffle as large as the
      input lands in about ``shuffle_partition_bytes`` per partition (the
      worst case; adaptive execution coalesces the smaller shuffles);
    * ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: the same target,
      so coalesced and split partitions also fit in an executor's memory
      (``parallelismFirst`` is off, or Spark would not honour it);
    * ``spark.sql.files.maxPartitionBytes``: the scan split.

    The same rule holds at every size: 100 TB give about 400 000 shuffle
    partitions and as many splits with the defaults; larger sizes for either
    trade fewer tasks for more memory in each.
    """
    partitions = max(200, -(-input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }


def bucket_count(input_bytes: int, bucket_bytes: int = 1024 * MIB, least: int = 8) -> int:
    """Buckets of about ``bucket_bytes`` each for ``input_bytes``: a power of two, so tables of any size join in step."""
    return max(least, 1 << max(0, -(-input_bytes // bucket_bytes) - 1).bit_length())


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Return a session with :data:`DEFAULT_CONF` plus ``conf``.

    ``master`` is left to the submitter (``spark-submit --master``) when
    ``None``.  ``input_bytes`` sizes partitions with :func:`scale_conf`.
    ``shuffle_partitions`` maps to ``spark.sql.shuffle.partitions``; with
    adaptive execution on it is an upper bound that AQE coalesces down.
    Explicit ``shuffle_partitions`` and ``conf`` win over the sizing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if input_bytes:
        settings.update(scale_conf(input_bytes))
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _size_listing(spark)
    return spark


_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _size_listing(spark: SparkSession) -> None:
    """Size the parallel file-listing job to the cluster unless configured.

    Reading a Hive-layout dataset with thousands of ``col=value/`` folders
    lists them in a Spark job with one task per folder (up to 10 000).  Two
    tasks per core keeps every core busy while each task lists a batch of
    folders, instead of thousands of tasks that each list one.
    """
    sc = spark.sparkContext
    if sc.getConf().contains(_LISTING_KEY):
        return
    spark.conf.set(_LISTING_KEY, str(2 * sc.defaultParallelism))


def require_local(master: str) -> None:
    """Raise unless ``master`` runs everything in this process, where a private folder is seen by all."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, for written tables and checkpoints.

    It is the checkpoint folder the cluster names (``spark.checkpoint.dir``,
    which Spark turns into ``SparkContext.getCheckpointDir()``).  Only when
    none is configured and the master is local -- a test run -- a private
    temporary folder is created and registered as the checkpoint folder; on
    any other master that is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        require_local(sc.master)
        base = tempfile.mkdtemp(prefix="ledgerline-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = base.rstrip("/")
    for part in parts:
        path = f"{path}/{part}"
    return path


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, never used sub-folder of :func:`shared_dir` (one per run)."""
    return shared_dir(spark, *parts, uuid.uuid4().hex)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme, for tests that inspect local output."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return os.fspath(uri)
