"""The tables of one lake."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone import values as V
from siltstone.sources.events import EventTable
from siltstone.sources.parts import PartTable
from siltstone.sources.tables import VersionedTable, ensure_namespace, publish

TABLES = (VersionedTable, PartTable, EventTable)


class Lake:
    """Data and control tables under one root folder (any Hadoop file system).

    ``base_buckets`` buckets the base table by its key, so a merge shuffles the batch
    only; choose it so that a bucket fits a task. ``key_buckets`` keeps the base table
    in that many parts by key, and Silver and fact in parts by year: a load then writes
    only the parts it changes, and marts take the difference. Choose several times as
    many as a usual batch has rows, or as many as files are worth having.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        base_buckets: int = 0,
        key_buckets: int = 0,
    ):
        if base_buckets and key_buckets:
            raise ValueError("Choose base_buckets or key_buckets.")
        self.spark = spark
        self.root = root.rstrip("/")
        self.in_parts = key_buckets > 0
        base = f"{self.root}/bronze/incident_reports"
        if self.in_parts:
            self.bronze = PartTable.by_key(spark, base, V.BUSINESS_KEY, key_buckets)
        else:
            self.bronze = VersionedTable(
                spark, base, bucket_key=V.BUSINESS_KEY, buckets=base_buckets
            )
        self.silver = self._dated("silver/incident_reports")
        self.summary = self._table("gold/monthly_summary")
        self.fact = self._dated("marts/incident_fact")
        self.trends = self._table("marts/monthly_trends")
        self.rates = self._table("marts/monthly_clearance_rates")
        self.runs = self._events(
            "control/pipeline_run", schemas.PIPELINE_RUN, "pipeline_run_id"
        )
        self.batches = self._events(
            "control/extract_batch", schemas.EXTRACT_BATCH, "extract_batch_id"
        )
        self.files = self._events(
            "control/raw_file_manifest",
            schemas.FILE_LEDGER,
            "extract_batch_id",
            "object_path",
        )
        self.watermarks = self._events(
            "control/source_watermark", schemas.WATERMARK, "dataset_id"
        )

    def _dated(self, name: str) -> VersionedTable | PartTable:
        if self.in_parts:
            return PartTable.by_year(self.spark, f"{self.root}/{name}", "occ_date")
        return self._table(name)

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def _events(self, name: str, schema: T.StructType, *ids: str) -> EventTable:
        return EventTable(self.spark, f"{self.root}/{name}", schema, ids)

    def control_runs(self) -> DataFrame:
        return self.runs.read()

    def control_batches(self) -> DataFrame:
        return self.batches.read()

    def control_files(self) -> DataFrame:
        return self.files.read()

    def control_watermarks(self) -> DataFrame:
        return self.watermarks.read()

    def publish(self, only_named: bool = False) -> list[str]:
        """Name every existing table in the catalog, for SQL users.

        A name shows the version that was the latest when it was given;
        ``only_named`` renews the names that exist already.
        """
        names = []
        for name, table in self.tables().items():
            if only_named and not self.spark.catalog.tableExists(name):
                continue
            if table.exists():
                ensure_namespace(self.spark, name.split(".")[0])
                publish(table, name)
                names.append(name)
        return names

    def tables(self) -> dict[str, VersionedTable | PartTable | EventTable]:
        """Every table by its name in the catalog."""
        found = [t for t in vars(self).values() if isinstance(t, TABLES)]
        return {".".join(t.path.split("/")[-2:]): t for t in found}


def one_row(spark: SparkSession, schema: T.StructType, **values) -> DataFrame:
    """A row of the given schema; fields without a value are NULL."""
    columns = [
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema
    ]
    return spark.range(1).select(*columns)

