"""Small mutable tables as appended events, read as the latest row of each id.

An event is a whole row as it is after a change, so one change is one small file
whatever the table holds. The same event appended again is recognized by its name and
changes nothing. Compaction writes the latest rows as the base of a new log; it shows
to readers once its commit is there, and the log before it stays for readers of the
version before. One writer per table.
"""

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.tables import VersionedTable

#: Events after which a log is compacted.
COMPACT_AFTER = 200

ORDER, EVENT = "_order", "_event"
MARKS = [T.StructField(ORDER, T.LongType()), T.StructField(EVENT, T.StringType())]


class EventTable:
    """Rows of ``schema``, one visible row for each value of the ``ids`` columns."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        ids: Sequence[str],
        *,
        compact_after: int = COMPACT_AFTER,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.ids = list(ids)
        self.compact_after = compact_after
        self.base = VersionedTable(spark, f"{self.path}/base")

    def exists(self) -> bool:
        return self._stored() is not None

    def _log(self) -> str:
        latest = self.base.latest()
        return f"{self.path}/log-{0 if latest is None else latest['version']:06d}"

    def _stored(self) -> DataFrame | None:
        """Base rows and the events after them, with their order and name."""
        layout = T.StructType([*self.schema.fields, *MARKS])
        latest = self.base.latest()
        base = [] if latest is None else [latest["path"]]
        for folders in ([*base, self._log()], base):
            try:
                if folders:
                    return self.spark.read.schema(layout).parquet(*folders)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        return None

    def _latest(self, events: DataFrame) -> DataFrame:
        """One row an id: combined in the map tasks, so a busy id stays small."""
        others = [f.name for f in events.schema if f.name not in self.ids]
        last = F.max_by(F.struct(*others), ORDER)
        return (
            events.groupBy(*self.ids)
            .agg(last.alias("_last"))
            .select(*self.ids, "_last.*")
        )

    def read(self, ids: DataFrame | None = None) -> DataFrame:
        """The latest row of each id, or of the given ids only."""
        events = self._stored()
        if events is None:
            return self.spark.createDataFrame([], self.schema)
        if ids is not None:
            wanted = ids.select(*self.ids).distinct()
            events = events.join(wanted, self.ids, "left_semi")
        return self._latest(events).select(*self.schema.names)

    def append(self, rows: DataFrame, event: str) -> bool:
        """Add rows, one an id, as one event; False when the event is known already."""
        last = logged = 0
        stored = self._stored()
        if stored is not None:
            in_log = F.col("_metadata.file_path").contains("/log-")
            found = stored.agg(
                F.max(ORDER).alias("last"),
                F.count_if(F.col(EVENT) == event).alias("known"),
                F.count_distinct(F.when(in_log, F.col(EVENT))).alias("logged"),
            ).first()
            if found["known"]:
                return False
            last, logged = found["last"] or 0, found["logged"]
        # Behind every event before, also when clocks differ between two drivers.
        order = max(time.time_ns(), last + 1)
        (
            rows.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema],
                F.lit(order).alias(ORDER),
                F.lit(event).alias(EVENT),
            )
            .write.mode("append")
            .parquet(self._log())
        )
        if logged >= self.compact_after:
            self.compact()
        return True

    def compact(self) -> int:
        """Make the latest rows the base of a new log; returns their number.

        Each keeps the name of its last event, so its repetition is still known.
        """
        stored = self._stored()
        return 0 if stored is None else self.base.replace(self._latest(stored))

    def view_sql(self) -> str:
        """The latest rows as a query over the base and the log as they are now."""
        folders = set(f.rsplit("/", 1)[0] for f in self._stored().inputFiles())
        columns = ", ".join(f"`{name}`" for name in self.schema.names)
        ids = ", ".join(f"`{name}`" for name in self.ids)
        scans = " UNION ALL ".join(
            f"SELECT {columns}, {ORDER} FROM parquet.`{folder}`"
            for folder in sorted(folders)
        )
        return (
            f"SELECT {columns} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {ids} ORDER BY {ORDER} DESC) AS _place FROM ({scans})) "
            "WHERE _place = 1"
        )
