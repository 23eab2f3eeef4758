"""Session construction and shared-folder helpers.

Scratch output (intermediate tables, streaming checkpoints, snapshots) always
lives under the shared folder named by ``spark.checkpoint.dir``.  That setting
is read from the running session; a local fallback is only installed when it
is unset and the master is local (unit tests, laptops).  On a cluster without
the setting the job fails, since machines don't see each other's disks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC makes hour buckets reproducible (the
# reference formatted hours in the JVM's zone); AQE re-plans joins/partition
# counts from real shuffle sizes and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove reliable checkpoint files once their DataFrames are unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpoint state as RocksDB changelogs instead of full snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Listing thousands of hour folders: a few tasks, each listing many
    # folders, instead of one task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


# Settings for a ~1000-executor cluster over ~100 TB of signals.  The shuffle
# partition count is deliberately high and AQE coalesces it to the advisory
# size, so a stage never has partitions that outgrow executor memory; splits
# of input files are capped at 256 MB; skewed join partitions beyond 512 MB
# are split; the broadcast threshold fits a national cell map (~50 MB) but
# not the user tables; state checkpoints upload only RocksDB changelogs; a
# decommissioned executor migrates its shuffle blocks instead of forcing
# recomputation.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
}


def build_session(master: str | None = "local[8]", app: str = "cellscope",
                  shuffle_partitions: int | None = 8, extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Local test session, or ``profile="cluster"`` (pass ``master=None`` under
    spark-submit)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None and profile == "local":
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level SQL settings the jobs assume (safe on an existing session)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.streaming.stateStore.providerClass",
              "spark.sql.sources.parallelPartitionDiscovery.parallelism"):
        spark.conf.set(k, BASE_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, installing a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir")
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="cellscope-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def _scratch_root(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cellscope/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables, once its results are written elsewhere
    (a returned DataFrame may still read them)."""
    from cellscope.sources import files

    files.delete(spark, _scratch_root(spark))


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
