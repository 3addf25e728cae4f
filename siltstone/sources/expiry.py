"""Removal of what no kept version lists.

Each commit is one file, so a version is forgotten by deleting its commit; what no
commit lists any more is deleted after that. A run that breaks off leaves only folders
that the next one finds. No job may write the table meanwhile.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.events import EventTable
from siltstone.sources.files import children, delete, qualified
from siltstone.sources.parts import PART, PartTable
from siltstone.sources.tables import VersionedTable


def _forget(commits: DataFrame, keep: int) -> None:
    """Delete the commits of all but the last versions, the oldest first."""
    if keep < 1:
        raise ValueError("At least one version has to stay.")
    files = commits.select("version", F.col("_metadata.file_path").alias("file"))
    found = files.distinct().orderBy("version").collect()
    versions = sorted({row["version"] for row in found})
    for row in found:
        if row["version"] in versions[:-keep]:
            delete(commits.sparkSession, row["file"])


def _drop(spark: SparkSession, folders: list[str], listed: set[str]) -> list[str]:
    gone = [folder for folder in folders if folder not in listed]
    for folder in gone:
        delete(spark, folder)
    return gone


def expire(table: VersionedTable | PartTable | EventTable, keep: int = 1) -> list[str]:
    """Keep the last versions readable and delete the rest; returns deleted folders."""
    spark = table.spark
    if not table.exists():
        return []
    if isinstance(table, EventTable):
        current = {qualified(spark, table._log())}
        logs = [c for c in children(spark, table.path) if "/log-" in c]
        return [*expire(table.base, keep), *_drop(spark, logs, current)]
    in_parts = isinstance(table, PartTable)
    _forget(table._commits() if in_parts else table.history(), keep)
    commits = table._commits() if in_parts else table.history()
    paths = commits.filter(F.col("path").isNotNull()).select("path").distinct()
    listed = {qualified(spark, row["path"]) for row in paths.collect()}
    folders = children(spark, f"{table.path}/data")
    if not in_parts:
        return _drop(spark, folders, listed)
    gone = []
    for folder in folders:
        parts = [c for c in children(spark, folder) if f"/{PART}=" in c]
        if any(part in listed for part in parts):
            gone += _drop(spark, parts, listed)
        else:
            gone += _drop(spark, [folder], listed)
    return gone
