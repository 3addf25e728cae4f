"""Rows laid out by key, with a directory of the keys that each file holds.

A page by key is then found in the directory, and only its files are opened, where
plain paging scans the source for every page.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import values as V


class KeyPages:
    """Sorted files of at most ``page_size`` rows under ``path``, and their directory."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key

    def write(self, rows: DataFrame, page_size: int = V.PAGE_SIZE) -> None:
        """Ranges of keys are spread over the tasks and sorted in each, NULLs first."""
        data = f"{self.path}/data"
        (
            rows.repartitionByRange(self.key)
            .sortWithinPartitions(self.key)
            .write.option("maxRecordsPerFile", page_size)
            .parquet(data)
        )
        files = (
            self.spark.read.parquet(data)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(
                F.min(self.key).alias("first_key"),
                F.max(self.key).alias("last_key"),
                F.count(F.lit(1)).alias("row_count"),
            )
        )
        files.write.parquet(f"{self.path}/directory")

    def directory(self) -> DataFrame:
        """File, first and last key, and rows, in the order of the keys."""
        found = self.spark.read.parquet(f"{self.path}/directory")
        return found.orderBy(F.asc_nulls_first("first_key"), "file")

    def _files(self, after, page_size: int) -> list[str]:
        """The files in which the page lies: a few at a time until they hold enough."""
        ahead = self.directory()
        if after is not None:
            ahead = ahead.filter(F.col("last_key") > after)
        wanted = 4
        while True:
            found = ahead.limit(wanted).collect()
            sure = 0
            for number, row in enumerate(found):
                # A file that starts before the page may hold no row of it.
                if after is None or (row["first_key"] or after) > after:
                    sure += row["row_count"]
                if sure >= page_size:
                    return [r["file"] for r in found[: number + 1]]
            if len(found) < wanted:
                return [row["file"] for row in found]
            wanted *= 4

    def page(self, after=None, page_size: int = V.PAGE_SIZE) -> DataFrame:
        """The next rows whose key is greater than ``after``, from their files alone."""
        files = self._files(after, page_size)
        stored = self.spark.read.parquet(f"{self.path}/data")
        rows = self.spark.read.schema(stored.schema)
        rows = rows.parquet(*files) if files else stored.limit(0)
        if after is not None:
            rows = rows.filter(F.col(self.key) > after)
        return rows.orderBy(self.key).limit(page_size)
