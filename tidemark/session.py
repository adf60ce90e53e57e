"""Session helpers: one place for the settings the library relies on.

Nothing here is required when a caller brings its own session; the library only
reads settings from the session it is given. ``scratch_dir`` is the one place
that decides where intermediate tables and stream checkpoints go.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this library is written against. AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small), splits
# skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent *and* the session runs in local mode (tests,
    the bench) is a private folder created and registered; on a cluster a
    missing setting is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # Spark appends a per-application uuid folder; its parent is the root.
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root for one job's files."""
    root = checkpoint_root(spark)
    # Whoever writes there makes the folder: the driver need not see the file system as a local one.
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 split_bytes: int = 256 * 1024 * 1024,
                 max_reducer_bytes: int = 1024 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    * initial shuffle partitions: at most ``max_reducer_bytes`` per reducer even
      if a whole input were shuffled, and at least three waves of tasks; AQE
      then coalesces partitions towards ``split_bytes``, so pruned or
      pre-aggregated shuffles (most of them here) end up with fewer, fuller
      tasks;
    * scan splits of ``split_bytes``;
    * skew-join splitting above four times the advisory size.

    For 100 TB on 1,000 executors of 8 cores: 102,400 initial shuffle
    partitions, 256 MB scan splits.
    """
    slots = executors * cores_per_executor
    partitions = max(3 * slots, -(-input_bytes // max_reducer_bytes))
    return {
        **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * split_bytes),
    }
