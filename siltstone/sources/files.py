"""Folders on any Hadoop file system."""

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Full paths of what a folder holds; nothing when it does not exist."""
    place, system = _open(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().toString() for status in system.listStatus(place))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings name it."""
    place, system = _open(spark, path)
    return system.makeQualified(place).toString()


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with its content; False when there was none."""
    place, system = _open(spark, path)
    return system.delete(place, True)
