"""Session helpers: time zone, checkpoint folder, a local builder for tests and bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings this package's plans are designed around on a large cluster (set them when the
# session is built; they are not applied behind the user's back).
RECOMMENDED_CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": UTC,
    # spark.checkpoint.dir: a shared folder (object store or distributed filesystem)
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "telemetry_spark") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", os.environ.get("TELEMETRY_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "Etc/Zulu", "UCT", "Universal", "+00:00", "GMT+0", "GMT0"}


def is_utc(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.session.timeZone") in UTC_NAMES


def ensure_utc(spark: SparkSession) -> None:
    """Event times are parsed in the session zone; a zone with daylight-saving jumps merges
    distinct wall-clock readings into one instant, so the contract is UTC.  The caller's
    session is theirs: it is checked, never changed."""
    if not is_utc(spark):
        zone = spark.conf.get("spark.sql.session.timeZone")
        raise ValueError(f"spark.sql.session.timeZone is {zone}; readings are parsed in UTC only "
                         "(set it when the session is built, or use utc_session)")


def utc_session(spark: SparkSession) -> SparkSession:
    """``spark`` if its zone is UTC, else a session beside it (same cluster) whose zone is."""
    if is_utc(spark):
        return spark
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", UTC)
    return own


def app_id(spark: SparkSession) -> str:
    """The application id (also where the session exposes no SparkContext)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext (e.g. a remote client)
        return spark.conf.get("spark.app.id", "") or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session.  Only when it is unset (local tests, the bench) is a
    folder of our own created and registered, so lineage can still be cut with
    ``DataFrame.checkpoint()`` and intermediate tables have somewhere durable to go.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this session: the setting is the only source
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return current
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="telemetry-checkpoint-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"
