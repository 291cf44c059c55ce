"""Session helpers.

Library code never creates a session; callers pass one in.  ``local_session``
exists for tests and the benchmark only.  ``checkpoint_root`` returns the shared
folder named by ``spark.checkpoint.dir``; only a local[N] session that names none
gets a private temporary folder, with a warning.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "scorewright",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Local session with an explicit folder for written intermediates (a new temporary one by default)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="scorewright-ckpt-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    event_dir = os.environ.get("SCOREWRIGHT_EVENT_LOG_DIR")
    if event_dir:  # local diagnosis: stage/task times without the UI
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """Identity of the running application (works for classic and Connect sessions)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # noqa: BLE001
        return f"session-{id(spark)}"


_private_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediates.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    storage).  Where it is unset, a session whose master is known to be
    ``local`` or ``local[...]`` gets a private folder, with a warning; any
    other raises.  The answer is remembered per application.
    """
    key = app_id(spark)
    if key in _private_roots:
        return _private_roots[key]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage (HDFS/S3/ABFS); "
                           "a machine-local folder cannot hold tables that every executor writes and reads")
    if not configured:
        configured = tempfile.mkdtemp(prefix="scorewright-ckpt-")
        warnings.warn(f"spark.checkpoint.dir is not set: written intermediates go to {configured}", stacklevel=2)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext on the client)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if not current:
            sc.setCheckpointDir(configured)
            current = sc.getCheckpointDir()
        root = current
    else:
        root = configured
    _private_roots[key] = root
    return root


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.conf.get("spark.master", "")
    except Exception:  # noqa: BLE001
        return False
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one written table."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Spark SQL settings sized from the input volume of one refresh.

    Shuffle partitions are chosen so an initial partition holds about
    ``target_partition_bytes`` of the largest input; AQE then coalesces
    small ones and splits skewed ones.  File splits stay at 128 MB so scan
    tasks fit comfortably in executor memory.  Apply with
    ``for k, v in cluster_settings(n).items(): spark.conf.set(k, v)``.
    """
    partitions = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split hot keys of a join even where a later operator then needs another shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
