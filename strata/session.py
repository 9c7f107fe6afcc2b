"""Session defaults and the shared state folder.

All durable state (bronze/silver/gold tables, stream checkpoints, schema
versions, event log) lives below one *state root*.  On a cluster that root is
the shared folder named by ``spark.checkpoint.dir``; we only pick a folder of
our own when the session has none (local runs and tests).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every strata job relies on.  UTC is required for day bucketing
# (``window`` aligns to UTC while ``cast(ts as date)`` uses the session zone).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # refresh checkpoints are transient
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def get_session(app: str = "strata", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with strata's defaults; ``conf`` overrides them.

    Shuffle width is left to the cluster (AQE coalesces from there); only a
    ``local[...]`` master gets a small default, sized to its cores.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(SESSION_DEFAULTS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            cores = master[len("local["):-1] if master.startswith("local[") else "1"
            settings["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8) if cores == "*" else cores
    for k, v in {**settings, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def state_root(spark: SparkSession) -> str:
    """The shared folder for durable state.

    Reads ``spark.checkpoint.dir`` (or a checkpoint dir set on the context);
    only when neither is set — local mode, tests — a folder is created and
    registered as the context's checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="strata-state-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_drop_lock, _drop_depth = threading.Lock(), {}  # by session: (how many are inside, the setting before the first)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when that query ends.

    Spark else keeps them until the driver's garbage collection meets the query's plan, so that the shuffles of all
    steps of an update lie on the executors' disks at once.  No step reads the shuffle of another.
    """
    key = spark._jsparkSession.sessionUUID()
    with _drop_lock:
        depth, before = _drop_depth.get(key) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _drop_depth[key] = (depth + 1, before)
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _drop_lock:
            depth, before = _drop_depth.pop(key)
            if depth > 1:
                _drop_depth[key] = (depth - 1, before)
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the state root for one run."""
    path = f"{state_root(spark)}/strata/{label}-{uuid.uuid4().hex[:12]}"
    return path
