"""Session settings the operators rely on."""

import tempfile
from functools import cache

from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "siltstone", **conf: str) -> SparkSession:
    """A session with the settings that change results or plans.

    Shuffle partition count, memory and master stay with the deployment
    (``spark-submit --conf``); pass ``conf`` to override, with ``__`` for dots.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.timeParserPolicy", "CORRECTED")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="siltstone-", dir="/tmp")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None)
    if named:
        return named.rstrip("/")
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError(f"Set {SHARED_DIR_CONF} to a folder all executors share.")
