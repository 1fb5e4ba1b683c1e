"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library expects. AQE re-plans joins and coalesces
# partitions from runtime statistics; skew join splits oversized join
# partitions; the session time zone is pinned so text formatting of dates is
# reproducible across clusters.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "curbline",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Without ``master`` the launcher's choice stands (spark-submit's ``--master``,
    the cluster's defaults); pass one only where there is no launcher.
    ``shuffle_partitions`` should be sized so that one shuffle partition stays
    around 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# private checkpoint folder per application, only when the setting is absent
_PRIVATE_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins (it is a core setting and cannot be
    changed on a running session). Where it is absent a local session gets a
    private folder; on a cluster that is an error, because the executors would
    not see a machine-local folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    private = _PRIVATE_DIRS.get(sc.applicationId)
    if private is None:
        private = tempfile.mkdtemp(prefix="curbline-ckpt-")
        _PRIVATE_DIRS[sc.applicationId] = private
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(private)
    return private


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for stream state."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
