"""Small helpers the operators of this folder share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from siltstone.sources.tables import staged

#: Rows that one Arrow batch hands to Python. Texts differ in length by a factor
#: of a thousand, so this bounds a worker's memory and changes no result.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame,
    rows: Callable[[dict], dict],
    schema: str,
    keep: bool = False,
) -> DataFrame:
    """Columns in, columns out, batch by batch.

    ``rows`` gets Arrow arrays by name and returns lists or arrays for ``schema``.
    With ``keep`` it makes one value a row, and they follow the columns of ``df``.
    """
    made = _parse_datatype_string(schema)
    result = T.StructType([*(df.schema.fields if keep else []), *made.fields])
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            found = rows({n: batch.column(i) for i, n in enumerate(names)})
            new = pa.RecordBatch.from_pydict(
                {n: found[n] for n in arrow.names}, schema=arrow
            )
            if keep:
                new = pa.RecordBatch.from_arrays(
                    [*batch.columns, *new.columns], names=[*names, *arrow.names]
                )
            yield new

    return df.mapInArrow(run, result)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty.

    ``bytes.split()`` and ``bytes.lower()`` know ASCII white space and letters only,
    which is what the word rules of this folder ask for.
    """
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


#: Folds ASCII letters to lower case and ASCII marks to spaces.
FOLD = bytes.maketrans(
    bytes(range(65, 91)) + bytes(c for c in range(33, 127) if not chr(c).isalnum()),
    bytes(range(97, 123)) + b" " * sum(not chr(c).isalnum() for c in range(33, 127)),
)


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def crc_mod(column: str, modulus: int):
    """crc32 of the number's text, modulo; a null number counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


__all__ = [
    "BATCH_ROWS",
    "FOLD",
    "crc_mod",
    "folded_words",
    "map_rows",
    "staged",
    "table",
    "texts_of",
]
