"""Tables as Parquet folders, one folder per version, plus a commit list.

A version is written to a new folder and becomes visible when its commit row is
appended, so a table can be rebuilt from itself and a failed write leaves the
previous version in place. One writer per table is assumed.
"""

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.session import shared_dir
from siltstone.sources.files import delete

APPEND = "append"
OVERWRITE = "overwrite"

#: Folders that this process staged and has not released.
_STAGED: list[str] = []


def write_by_year(df: DataFrame, path: str, date_column: str, year_column: str) -> None:
    """Parquet partitioned by the year of a date.

    The rebalance hint lets the adaptive planner split a year that outgrows a
    task and join years that do not fill one, so neither a huge year nor many
    small files come out.
    """
    (
        df.withColumn(year_column, F.year(date_column))
        .hint("rebalance", year_column)
        .write.partitionBy(year_column)
        .parquet(path)
    )


def with_year_range(
    df: DataFrame, date_column: str, year_column: str, first, last
) -> DataFrame:
    """Rows dated from first to last, both included, reading only their years."""
    return df.filter(
        F.col(year_column).between(F.year(F.lit(first)), F.year(F.lit(last)))
        & F.col(date_column).between(F.lit(first), F.lit(last))
    )


def partition_stats(df: DataFrame, partition_column: str) -> DataFrame:
    """Records and data files per partition value."""
    per_file = df.groupBy(
        F.col(partition_column), F.col("_metadata.file_path").alias("file_path")
    ).agg(F.count(F.lit(1)).alias("records"))
    return per_file.groupBy(partition_column).agg(
        F.sum("records").alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
    )


def _type(name: str):
    return schemas.COMMIT[name].dataType


def _catalog_name(folder: str) -> str:
    return "siltstone_" + folder.rsplit("/", 1)[1].replace("-", "_")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage, so later steps neither repeat the work nor depend on the
    executors that did it, and keeps column pruning, unlike a checkpoint.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/siltstone/{purpose}-{uuid.uuid4().hex}"
    _STAGED.append(folder)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def release_staged(spark: SparkSession) -> int:
    """Delete what this process staged; returns the number of folders.

    For the end of a job: results that still read staged rows are lost.
    """
    released = 0
    while _STAGED:
        released += delete(spark, _STAGED.pop())
    return released


class VersionedTable:
    """A Parquet table whose whole content is replaced by each commit.

    With ``bucket_key`` and ``buckets`` the files are bucketed by the key, so joins
    on it need no shuffle of this table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        bucket_key: str | None = None,
        buckets: int = 0,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket_key = bucket_key
        self.buckets = buckets if bucket_key else 0

    def history(self) -> DataFrame:
        """Version, time, operation, folder and record count of every commit."""
        try:
            return self.spark.read.schema(schemas.COMMIT).parquet(
                f"{self.path}/commits"
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schemas.COMMIT)

    def latest(self) -> Row | None:
        return self.history().orderBy(F.desc("version")).first()

    def exists(self) -> bool:
        return self.latest() is not None

    def read(self, version: int | None = None) -> DataFrame:
        commits = self.history()
        if version is not None:
            commits = commits.filter(F.col("version") == version)
        commit = commits.orderBy(F.desc("version")).first()
        if commit is None:
            raise ValueError(f"No such table version: {self.path} {version or ''}")
        files = self.spark.read.parquet(commit["path"])
        if not commit["buckets"]:
            return files
        # A catalog entry tells Spark about the buckets; the files stay where they are.
        name = _catalog_name(commit["path"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
        key = f"`{commit['bucket_key']}`"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {commit['buckets']} BUCKETS "
            f"LOCATION '{commit['path']}'"
        )
        return self.spark.table(name)

    def replace(
        self,
        df: DataFrame,
        *,
        year_of: str | None = None,
        year_column: str | None = None,
        keeps_buckets: bool = False,
        source_version: int | None = None,
    ) -> int:
        """Make ``df`` the content of the table; returns the rows written."""
        folder = self.write(
            df,
            year_of=year_of,
            year_column=year_column,
            keeps_buckets=keeps_buckets,
        )
        return self.commit(folder, source_version)

    def write(
        self,
        df: DataFrame,
        *,
        year_of: str | None = None,
        year_column: str | None = None,
        keeps_buckets: bool = False,
    ) -> str:
        """Write ``df`` as a folder that no reader sees before ``commit``.

        ``keeps_buckets`` says that ``df`` comes out of a join of this table on its
        key: each task then holds one bucket already and nothing is shuffled.
        """
        previous = self.latest()
        version = 1 if previous is None else previous["version"] + 1
        folder = f"{self.path}/data/{version:06d}-{uuid.uuid4().hex}"
        if self.buckets:
            key = self.bucket_key
            same = previous is not None and previous["buckets"] == self.buckets
            aligned = keeps_buckets and same
            rows_by_bucket = df if aligned else df.repartition(self.buckets, key)
            (
                rows_by_bucket.write.bucketBy(self.buckets, key)
                .sortBy(key)
                .option("path", folder)
                .saveAsTable(_catalog_name(folder), format="parquet")
            )
        elif year_of is None:
            df.write.parquet(folder)
        else:
            write_by_year(df, folder, year_of, year_column or f"{year_of}_year")
        return folder

    def commit(self, folder: str, source_version: int | None = None) -> int:
        """Make a written folder the content of the table; returns its rows.

        ``source_version`` notes the version of the table that this one was made from.
        """
        previous = self.latest()
        version = 1 if previous is None else previous["version"] + 1
        # Counted from the files rather than while writing: lost and repeated
        # tasks cannot distort it, and Parquet answers it from the footers.
        rows = self.spark.read.parquet(folder).count()
        commit = {
            "version": version,
            "committed_at": datetime.now(timezone.utc),
            "operation": APPEND if previous is None else OVERWRITE,
            "path": folder,
            "record_count": rows,
            "bucket_key": self.bucket_key if self.buckets else None,
            "buckets": self.buckets,
            "source_version": source_version,
        }
        (
            self.spark.range(1)
            .select(*[F.lit(v).cast(_type(k)).alias(k) for k, v in commit.items()])
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/commits")
        )
        return rows


    def view_sql(self) -> str:
        return f"SELECT * FROM parquet.`{self.latest()['path']}`"


def publish(table, name: str) -> None:
    """Give the latest version a catalog name, for SQL users."""
    table.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {table.view_sql()}")


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def preview(df: DataFrame, columns: Sequence[str], rows: int = 5) -> None:
    df.printSchema()
    df.select(*columns).show(rows, truncate=False)
