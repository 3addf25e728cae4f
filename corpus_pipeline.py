"""Documents to training sequences: five stages, each over all that the last kept."""

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import (
    decontamination,
    near_duplicates,
    packing,
    quality_rules,
    toxicity,
)
from siltstone.llm.common import staged, table

#: No SQL: the verdicts come from models fitted on the data. Tests compare the
#: stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filtered(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier ordinary than toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.filtered(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.filtered(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them the rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
