"""Session construction and the shared scratch folder.

Library code never creates its own session: every operator takes a
DataFrame (or a ``SparkSession``) from the caller.  ``build_session`` is
only a convenience for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should carry.  The session time
# zone is pinned to UTC so that a TIMESTAMP -> DATE cast never depends on
# the machine it runs on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only once its size is measured: never from the
    # planner's estimate (compressed file bytes, no bound on the in-memory
    # size), only when AQE has seen the side's actual shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Driver-side cost only: recording the Python call site of every Column
    # call for error messages makes plan construction ~40% slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "adlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime SQL settings also apply when getOrCreate returned an existing session.
    for key in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, conf[key])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is a shared file system (HDFS, object store), so
    anything written under it survives the loss of an executor.  Only when
    the setting is absent in a local session (a test) do we set one under
    the system temporary folder; on a cluster its absence is an error.
    """
    context = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if context is None or not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "adlens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/adlens/{name}-{uuid.uuid4().hex}"


def apply_defaults(spark: SparkSession) -> None:
    """Set every default that a running session lets us set."""
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def input_bytes(*frames: DataFrame) -> int:
    """Size of the files behind ``frames``, as the planner knows it from their listing."""
    return sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames)


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20,
                  min_partitions: int = 200, max_partitions: int = 100_000) -> int:
    """Size shuffles and scan splits for an input of ``input_bytes``.

    Starts AQE from about one shuffle partition per ``partition_bytes`` of
    input (an upper bound: partial aggregation shrinks what is shuffled, and
    AQE coalesces partitions down to its advisory size at run time), and
    keeps scan splits at ``partition_bytes`` so every task fits in memory.
    """
    n = max(min_partitions, min(max_partitions, -(-int(input_bytes) // partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    return n
