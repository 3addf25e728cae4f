"""The operators over the given tables, with production parameters."""

from siltstone.llm import (
    centroid_clustering,
    conversation_repair,
    cotraining,
    decontamination,
    hmm_score,
    html_text,
    licenses,
    near_duplicates,
    packing,
    quality_rules,
    source_mixing,
    toxicity,
    url_filter,
)
from siltstone.llm.common import table
from siltstone.llm.oracles import ORACLES

QUERIES = {}


def query(make):
    QUERIES[make.__name__] = make
    return make


@query
def op6_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model)


@query
def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op4_decontamination(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return decontamination.leaks(documents, table(spark, sf_dir, "benchmark"))


@query
def op1_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_hmm_score(spark, sf_dir):
    return hmm_score.score(table(spark, sf_dir, "documents"))


@query
def op2_cotraining(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return cotraining.score(documents, table(spark, sf_dir, "labels"))


@query
def op11_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(conversations))


@query
def op12_source_mixing(spark, sf_dir):
    return source_mixing.mix(table(spark, sf_dir, "documents"))


@query
def op13_centroid_clustering(spark, sf_dir):
    assigned, centroids = centroid_clustering.cluster(table(spark, sf_dir, "embeddings"))
    return centroid_clustering.with_inertia(assigned, centroids)


__all__ = ["ORACLES", "QUERIES"]
