"""Tables in parts, each part in a folder of its own; a commit replaces whole parts.

A commit lists the folder of every part. Parts that it does not replace keep the
folder they had, so a small change costs what its parts hold and not what the table
holds, and two versions show by their lists where they can differ. Readers see a
version once its list is there, which is one file. One writer per table.

A part is a label computed from a row: a bucket of its key (``key_buckets``) or the
year of a date (``years``).
"""

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone.sources.tables import APPEND, OVERWRITE

PART = "_part"
NO_YEAR = "none"


def key_buckets(key: str, buckets: int) -> Column:
    """Label of the bucket of a key; a NULL key has a bucket too."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))


def years(date: str) -> Column:
    """Label of the year of a date; rows without a date share a part."""
    return F.coalesce(
        F.concat(F.lit("y"), F.year(date).cast("string")), F.lit(NO_YEAR)
    )


@dataclass(frozen=True)
class Version:
    """What a commit lists: folder and records of each part."""

    number: int
    layout: T.StructType
    parts: dict[str, tuple[str, int]]

    def records(self, parts: Iterable[str] | None = None) -> int:
        names = self.parts if parts is None else set(parts)
        return sum(count for name, (_, count) in self.parts.items() if name in names)


class PartTable:
    """``label`` is the part of a row, from the columns of the table.

    ``rule`` names how it is computed; opening a table under another rule is refused,
    as its rows would be sought in the wrong parts.
    """

    def __init__(
        self, spark: SparkSession, path: str, label: Callable[[], Column], rule: str
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.label = label
        self.rule = rule

    @classmethod
    def by_key(cls, spark: SparkSession, path: str, key: str, buckets: int):
        rule = f"{buckets} buckets of {key}"
        return cls(spark, path, lambda: key_buckets(key, buckets), rule)

    @classmethod
    def by_year(cls, spark: SparkSession, path: str, date: str):
        return cls(spark, path, lambda: years(date), f"years of {date}")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(schemas.PART_COMMIT).parquet(
                f"{self.path}/commits"
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schemas.PART_COMMIT)

    def history(self) -> DataFrame:
        """Version, time, operation, records and replaced parts of every commit."""
        return self._commits().filter(F.col("part").isNull()).drop("part", "path")

    def latest(self) -> Row | None:
        return self._commit(None)

    def exists(self) -> bool:
        return self.latest() is not None

    def _commit(self, number: int | None) -> Row | None:
        commits = self.history()
        if number is not None:
            commits = commits.filter(F.col("version") == number)
        commit = commits.orderBy(F.desc("version")).first()
        if commit is not None and commit["rule"] != self.rule:
            raise ValueError(f"{self.path} has parts by {commit['rule']}.")
        return commit

    def version(self, number: int | None = None) -> "Version":
        """A version with the list of its parts, the latest by default."""
        commit = self._commit(number)
        if commit is None:
            raise ValueError(f"No such table version: {self.path} {number or ''}")
        listed = self._commits().filter(
            (F.col("version") == commit["version"]) & F.col("part").isNotNull()
        )
        # One row a part.
        parts = {r["part"]: (r["path"], r["record_count"]) for r in listed.collect()}
        return Version(
            number=commit["version"],
            layout=T.StructType.fromJson(json.loads(commit["layout"])),
            parts=dict(sorted(parts.items())),
        )

    def parts(self) -> DataFrame:
        """Part, folder and records of the parts of the latest version."""
        lines = [(part, *found) for part, found in self.version().parts.items()]
        return self.spark.createDataFrame(
            lines, "part string, path string, record_count long"
        )

    def read(
        self, parts: Iterable[str] | None = None, version: "Version | None" = None
    ) -> DataFrame:
        """The rows, or those of the given parts; other folders are not opened."""
        shown = self.version() if version is None else version
        names = shown.parts if parts is None else set(parts)
        paths = [path for name, (path, _) in shown.parts.items() if name in names]
        if not paths:
            return self.spark.createDataFrame([], shown.layout)
        return self.spark.read.schema(shown.layout).parquet(*paths)

    def labels(self, *rows: DataFrame) -> list[str]:
        """The parts that rows belong to; as many at most as there are labels."""
        named = [df.select(self.label().alias("part")) for df in rows]
        return [r["part"] for r in reduce(DataFrame.unionAll, named).distinct().collect()]

    def write(self, df: DataFrame, folder: str | None = None, spread: bool = True) -> str:
        """Write rows as one folder a part that no reader sees before ``commit``.

        The rebalance hint splits a part that outgrows a task and joins small ones.
        Rows that come straight from files of this table need no ``spread``: a file
        holds one part, so a task writes no more files than it reads. ``folder`` adds
        to what was written before.
        """
        folder = folder or f"{self.path}/data/{uuid.uuid4().hex}"
        rows = df.withColumn(PART, self.label())
        if spread:
            rows = rows.hint("rebalance", PART)
        rows.write.mode("append").partitionBy(PART).parquet(folder)
        return folder

    def written(self, folder: str, layout: T.StructType) -> DataFrame:
        """Rows of a written folder with their part."""
        named = T.StructType([*layout.fields, T.StructField(PART, T.StringType())])
        return self.spark.read.schema(named).parquet(folder)

    def counted(self, folder: str, layout: T.StructType) -> dict[str, tuple[str, int]]:
        """Folder and records of each written part."""
        counts = self.written(folder, layout).groupBy(PART).count().collect()
        return {r[PART]: (f"{folder}/{PART}={r[PART]}", r["count"]) for r in counts}

    def commit(
        self,
        written: dict[str, tuple[str, int]],
        layout: T.StructType,
        replaced: Iterable[str] | None = None,
        source_version: int | None = None,
    ) -> int:
        """Put written parts in the place of the replaced ones (all by default).

        Returns the rows of the table. ``source_version`` notes the version of the
        table that this one was made from.
        """
        previous = self.version() if self.exists() else None
        gone = set(written) | set(replaced or ())
        parts = dict(written)
        if replaced is not None and previous is not None:
            parts |= {n: p for n, p in previous.parts.items() if n not in gone}
        rows = sum(count for _, count in parts.values())
        shared = (
            1 if previous is None else previous.number + 1,
            datetime.now(timezone.utc),
            APPEND if previous is None else OVERWRITE,
        )
        header = (None, None, rows, len(gone), layout.json(), self.rule, source_version)
        lines = [(*shared, *header)]
        for name, (path, count) in sorted(parts.items()):
            lines.append((*shared, name, path, count, None, None, None, None))
        (
            self.spark.createDataFrame(lines, schemas.PART_COMMIT)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/commits")
        )
        return rows

    def replace(self, df: DataFrame, source_version: int | None = None) -> int:
        """Make ``df`` the content of the table; returns the rows written."""
        written = self.counted(self.write(df), df.schema)
        return self.commit(written, df.schema, source_version=source_version)

    def view_sql(self) -> str:
        """A query for SQL users: one scan for each folder that still has parts."""
        version = self.version()
        folders: dict[str, list[str]] = {}
        for name, (path, _) in version.parts.items():
            folder = path.rsplit(f"/{PART}=", 1)[0]
            folders.setdefault(folder, []).append(f"'{name}'")
        if not folders:
            nulls = ", ".join(
                f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in version.layout
            )
            return f"SELECT {nulls} WHERE false"
        columns = ", ".join(f"`{name}`" for name in version.layout.names)
        return " UNION ALL ".join(
            f"SELECT {columns} FROM parquet.`{folder}` "
            f"WHERE {PART} IN ({', '.join(sorted(names))})"
            for folder, names in sorted(folders.items())
        )
