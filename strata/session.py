"""Session factory and shared-storage scratch paths.

Results depend on a few settings (UTC for ``year``/``month``, ANSI on), so the
factory sets them on every session it hands out, including a reused one.
"""

from __future__ import annotations

import importlib.util
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results or the plans depend on.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits a hot partition-column value over several writer tasks.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Rows of whole texts that go to Python at once: a few MB instead of tens.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Only static confs: these cannot change on a running session.
_STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def delta_available(spark: SparkSession) -> bool:
    """True when the Delta Lake package and its jar are both there."""
    if importlib.util.find_spec("delta") is None:
        return False
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
    except Exception:
        return False
    return True


def get_session(
    app_name: str = "strata",
    *,
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session (settings applied) or build a new one.

    ``master`` is only needed outside ``spark-submit``; a submitted job keeps
    the cluster's master. A session for Delta tables gets Delta's extension and
    catalog through ``conf``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        _apply_runtime(active, conf)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_STATIC_DEFAULTS, **_SESSION_DEFAULTS}.items():
        builder = builder.config(key, value)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _apply_runtime(spark, conf)
    return spark


def configure(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """Apply the result-relevant settings to a session built elsewhere."""
    _apply_runtime(spark, conf)
    return spark


def _apply_runtime(spark: SparkSession, conf: dict[str, str] | None) -> None:
    # Python workers import this package from where the driver did; on a
    # cluster it is installed or shipped with --py-files, and the entry is idle.
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (here, path) if p)
    for key, value in {**_SESSION_DEFAULTS, **(conf or {})}.items():
        if key in _STATIC_DEFAULTS or key.startswith("spark.ui"):
            continue
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf passed by the caller on a running session
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session without one (tests) gets
    a fresh local folder; on a cluster a missing setting is an error, since
    executors must never write to machine-local paths.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach; "
            "scratch output cannot go to a machine-local folder on a cluster"
        )
    local = tempfile.mkdtemp(prefix="strata-checkpoint-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"
