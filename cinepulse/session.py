"""Session helpers: a local session for tests and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cinepulse", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine (UI off, UTC, AQE on);
    ``extra`` settings override these."""
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:
        return None


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by the whole cluster, taken from ``spark.checkpoint.dir``.

    Lake tables, stream sources, sinks and streaming checkpoints all live below it.
    Only a local-mode session without that setting gets a fresh temporary folder
    (tests); on a cluster the setting is required, since a machine-local folder
    would not survive the loss of an executor.
    """
    path = _conf(spark, "spark.checkpoint.dir")
    sc = None
    try:
        sc = spark.sparkContext  # classic sessions only
        if not path:
            current = sc._jsc.sc().getCheckpointDir()
            path = current.get() if current.isDefined() else None
    except Exception:  # Spark Connect: only the conf is visible
        pass
    if not path:
        master = sc.master if sc is not None else (_conf(spark, "spark.master") or "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="cinepulse-")
        if sc is not None:
            sc.setCheckpointDir(path)
            current = sc._jsc.sc().getCheckpointDir()
            path = current.get() if current.isDefined() else path
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/cinepulse/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme, for tests that look at files."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_utc(spark: SparkSession) -> None:
    """The library assumes a UTC session (timestamps without zone are UTC wall time)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


__all__ = ["local_session", "shared_dir", "fresh_path", "local_fs_path", "ensure_utc"]
