"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are written for. ANSI stays on (Spark 4 default);
# operators use try_cast / nullif where the old non-ANSI runtime gave NULL.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, executor_memory_gb: float = 16.0, executor_cores: int = 4,
                 executors: int = 1000, shuffle_fraction: float = 0.3) -> dict:
    """Settings for a cluster run over ``input_bytes`` of Parquet (e.g. 100 TB).

    * scan splits of 512 MB: 100 TB -> ~200k map tasks, which keeps the
      map x reduce block count and the driver's map statuses manageable;
    * reducers sized for the largest shuffle of these jobs, not the input:
      marts shuffle partial aggregates only, the biggest shuffles (sync keys,
      duplicate-key profile) carry about ``shuffle_fraction`` of the input
      bytes. Each reducer gets ~512 MB (at most 1/4 of a core's memory
      share, so sorts spill rarely), at least 2 waves of the cluster's cores,
      at most 100k partitions; AQE coalesces small shuffles back to the
      advisory size;
    * skew join on: a partition is skewed from 5x the median and 1 GB, and
      is split into advisory-size pieces;
    * dimension joins broadcast up to 64 MB (Spark's own size estimate), or
      after ``checked_broadcast``'s row count.
    """
    split = 512 * 1024 ** 2
    cores = executors * executor_cores
    per_core_mem = executor_memory_gb * 1024 ** 3 / executor_cores
    target = int(min(512 * 1024 ** 2, per_core_mem / 4))
    largest_shuffle = int(input_bytes * shuffle_fraction)
    partitions = min(100_000, max(2 * cores, -(-largest_shuffle // target)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 ** 3),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster the launcher owns
    master, memory and spark.checkpoint.dir; pass only what is missing."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, set from ``spark.checkpoint.dir``.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    wins. Only when it is unset in a local session (local runs, tests) a
    scratch folder is made; a cluster session without it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the checkpoint folder
        shared = spark.conf.get("spark.checkpoint.dir", "")
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the server")
        return shared
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive the loss of an executor
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                               "for cluster runs")
        # local runs and tests only: no shared folder was named
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables (under the checkpoint folder)."""
    d = ensure_checkpoint_dir(spark)
    return d.rstrip("/") + "/tillroll-work"

