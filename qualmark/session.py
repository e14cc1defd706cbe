"""Session helpers: a local session for tests/bench and shared scratch paths.

Library functions never build a session; callers pass theirs. Scratch data
(round trips, lineage cuts) goes under the shared folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) do we set one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "qualmark", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    # the same skew handling as on a cluster; partition sizes stay local-sized
    for key, val in cluster_settings().items():
        if key.startswith("spark.sql.adaptive.skewJoin") or key == "spark.sql.optimizer.windowGroupLimitThreshold":
            spark.conf.set(key, val)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client, read the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(a machine-local temporary folder does not survive executor loss)")
        configured = tempfile.mkdtemp(prefix="qualmark-ckpt-")   # local sessions (tests) only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared checkpoint folder."""
    app = spark.conf.get("spark.app.id", "app")
    return os.path.join(ensure_checkpoint_dir(spark), "qualmark-scratch", app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the application's scratch folder."""
    return os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession, name: str = "") -> None:
    """Delete the intermediate tables this application wrote (those of ``name`` only,
    if given). Call it when no DataFrame that reads them is needed any more: a
    finished job's results are written, its intermediate tables are not."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(os.path.join(_scratch_root(spark), f"{name}-*" if name else "*"))
    fs = found.getFileSystem(conf)
    for status in fs.globStatus(found) or []:
        fs.delete(status.getPath(), True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` (and survives executor loss), but
    computes the plan once: ``Dataset.checkpoint`` runs it a second time to
    write the checkpoint files unless the data is also cached.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# Largest table we broadcast after counting it (rows x estimated row bytes).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def broadcast_if_small(small, other, row_bytes: int, max_bytes: int | None = None):
    """Size-checked broadcast: hint ``small`` for broadcast when its counted
    size is under ``max_bytes``; otherwise force a sort-merge join so the
    other (growing) side is never broadcast from a low static estimate.

    ``small`` should be materialised (its count is then a cheap scan).
    Returns ``(small, other)`` with the hints applied.
    """
    from pyspark.sql import functions as F
    limit = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    if small.count() * row_bytes <= limit:
        return F.broadcast(small), other
    return small.hint("merge"), other.hint("merge")


def cluster_settings(input_bytes: int | None = None) -> dict[str, str]:
    """Session settings for large runs (apply with ``SparkSession.builder.config``).

    The heavy stages are the first aggregates over the raw logs; they combine
    map-side, so their shuffles are small next to the scan. Splits of 256 MB
    keep scan tasks large; AQE coalesces small shuffle partitions and splits
    skewed ones (a series or key holding a third of the rows) in joins. The
    shuffle partition count is sized from the input volume and then left to
    AQE. The broadcast threshold equals the limit of ``broadcast_if_small``.
    """
    parts = 2000 if input_bytes is None else max(200, min(50000, int(input_bytes // (8 * 1024 ** 3))))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_MAX_BYTES),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    }
