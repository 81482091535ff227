"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Time is UTC wall clock throughout: event time columns are TIMESTAMP_NTZ, and a
# UTC session leaves them alone where Spark goes through the zoned type.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Fixed when the session starts. A call site per column costs several round
# trips to the JVM; one application runs many plans, so their code stays cached.
STATIC_DEFAULTS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.redaction.string.regex": "(?i)secret|password|token|access[.]key",
}


def create_session(app_name: str, extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults every job expects."""
    conf = {**STATIC_DEFAULTS, **RUNTIME_DEFAULTS, **(extra_conf or {})}
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the defaults on a session somebody else created."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="repopulse-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the scratch root, removed when the session's JVM ends."""
    path = f"{scratch_root(spark)}/repopulse/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return path
