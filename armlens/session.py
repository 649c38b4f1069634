"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Static: call-site capture costs several round trips to the JVM for every column expression.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC) and the adaptive ones; returns the session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("armlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_FOLDERS: dict[str, str] = {}  # application id -> folder, for local sessions without one
_SCRATCH: dict[str, list[str]] = {}  # application id -> scratch paths handed out


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back on a folder of its own; elsewhere a missing setting is an
    error, because a machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="armlens-")
        atexit.register(shutil.rmtree, _OWN_FOLDERS[application], ignore_errors=True)
    return _OWN_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root; never used twice."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever store it lies; False when there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application; to be called once their results are stored.

    Frames that still read them are not usable afterwards. Returns how many were there.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    return sum(drop_path(spark, path) for path in paths)
