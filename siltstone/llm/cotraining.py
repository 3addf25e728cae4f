"""Quality classifier by co-training of two views.

One classifier sees the text's content, the other the page's metadata. In each round
both look at another part of all unlabelled texts and label those they are surest of
for the other; labels add up over the rounds. Both are then calibrated on labelled
rows that neither was fitted on, and every document gets the combined chance.
"""

from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import crc_mod, staged

#: Labelled rows that are used at most: those with the lowest hash of their id. A fifth
#: of them calibrate.
FIT_ROWS = 6_000
CALIBRATION = 5
#: Unlabelled texts are split into as many parts by hash as there are rounds.
ROUNDS = 2
#: Share of a part that a view labels in each class, and how sure it has to be at
#: least. The chance that so many labelled rows of the class reach is the limit; where
#: more reach it, as with equal metadata, texts are picked by hash.
SHARE, SURE = 0.05, 0.9
CONTENT_SIZE, METADATA_SIZE = 4096, 256
VIEWS = ("content", "metadata")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SHAPES = "A" * 26 + "a" * 26 + "9" * 10


def _words(text: Column) -> Column:
    found = F.split(text, "[\\x20\\x09-\\x0D]+")
    return F.filter(found, lambda w: w != "")


def views(documents: DataFrame) -> DataFrame:
    """The columns of ``documents`` with a ``content`` and a ``metadata`` vector.

    Content: words, their shapes (letters folded into classes, runs into one), and
    how varied and long the words are. Metadata: language, source and length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    shaped = F.regexp_replace(F.translate(text, LETTERS, SHAPES), r"[a\P{ASCII}]+", "a")
    words, shapes = _words(F.lower(text)), _words(shaped)
    number = F.greatest(F.size("llm_words"), F.lit(1)).cast("double")
    known = ((F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("lang", "source"))
    lang, source = known
    length = F.log1p(F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)))
    tagged = documents.withColumn("llm_words", words).withColumns(
        {
            "llm_terms": F.concat(
                "llm_words", F.transform(shapes, lambda s: F.concat(F.lit("\x00"), s))
            ),
            "llm_variety": F.size(F.array_distinct("llm_words")) / number,
            "llm_size": F.log1p(number),
            "llm_length": F.length(text) / number,
            "llm_tags": F.array(
                F.concat(F.lit("lang="), lang),
                F.concat(F.lit("source="), source),
                F.concat(F.lit("length="), F.floor(2 * length).cast("string")),
            ),
        }
    )
    hashed = HashingTF(
        numFeatures=CONTENT_SIZE, inputCol="llm_terms", outputCol="llm_counts"
    ).transform(tagged)
    shares = Normalizer(p=1.0, inputCol="llm_counts", outputCol="llm_shares")
    content = VectorAssembler(
        inputCols=["llm_shares", "llm_variety", "llm_size", "llm_length"],
        outputCol="content",
    )
    metadata = HashingTF(
        numFeatures=METADATA_SIZE, binary=True, inputCol="llm_tags", outputCol="metadata"
    )
    made = metadata.transform(content.transform(shares.transform(hashed)))
    return made.drop(*(c for c in made.columns if c.startswith("llm_")))


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _usable(labels: DataFrame) -> DataFrame:
    usable = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
    return usable.groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))


def _sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Views of the labelled sample, with ``label``."""
    chosen = _usable(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    # At most FIT_ROWS pairs of numbers.
    return views(documents.select(*COLUMNS).join(F.broadcast(chosen), "doc_id")).drop("text")


def _chance(view: str) -> Column:
    return vector_to_array(F.col(f"{view}_probability"))[1]


def _classifier(view: str, rows: DataFrame):
    return LogisticRegression(
        featuresCol=view,
        labelCol="label",
        weightCol="weight",
        maxIter=15,
        regParam=0.01,
        predictionCol=f"{view}_prediction",
        probabilityCol=f"{view}_probability",
        rawPredictionCol=f"{view}_raw",
    ).fit(_weighted(rows))


def _weighted(rows: DataFrame) -> DataFrame:
    """Both classes weigh the same, and so do given and exchanged labels of a class.

    However many texts are exchanged, they count as much as the labelled rows.
    """
    sums = rows.groupBy("label", "given").count().collect()
    total = sum(r["count"] for r in sums if r["given"])
    weight = reduce(
        lambda c, r: c.when(
            (F.col("label") == r["label"]) & (F.col("given") == r["given"]),
            total / (2.0 * r["count"]),
        ),
        sums,
        F,
    )
    return rows.withColumn("weight", weight.otherwise(1.0))


def _limits(fitted: DataFrame, view: str, model) -> dict[float, tuple[float, float]]:
    """For each class how sure to be, and which share of such texts to take."""
    # At most FIT_ROWS pairs of numbers.
    rows = model.transform(fitted).select(_chance(view).alias("chance"), "label").toPandas()
    limits = {}
    for label in (0.0, 1.0):
        chance = rows.chance[rows.label == label].to_numpy()
        sure = chance if label else 1 - chance
        limit = max(SURE, float(np.quantile(sure, 1 - SHARE)))
        beyond = float((sure >= limit).mean())
        limits[label] = limit, min(1.0, SHARE / beyond) if beyond else 1.0
    return limits


def _exchange(documents: DataFrame, usable: DataFrame, models, limits, part: int) -> DataFrame:
    """Both views of each distinct text of a part that some view is sure of.

    ``by_content`` and ``by_metadata`` are the labels, null if the view is not sure.
    Texts of labelled documents are left out, and empty ones.
    """
    key = F.xxhash64("text")
    rows = documents.select(*COLUMNS).where("doc_id IS NOT NULL AND trim(text) <> ''")
    found = views(rows.where(F.pmod(key, F.lit(ROUNDS)) == part)).withColumn("key", key)
    for view in VIEWS:
        found = models[view].transform(found)
        chance = _chance(view)
        draw = F.pmod(F.xxhash64("key", F.lit(view)), F.lit(2**20)) / 2**20
        label = F
        for value, (limit, share) in limits[view].items():
            sure = chance if value else 1 - chance
            label = label.when((sure >= limit) & (draw < share), value)
        found = found.withColumn(f"by_{view}", label)
    labels = [f"by_{v}" for v in VIEWS]
    # Rows go by way of an array, as a condition moved below the models would run them
    # once for each place that it names their results.
    row = F.array(F.struct("doc_id", "key", *VIEWS, *labels))
    sure = F.filter(row, lambda r: F.coalesce(*(r[c] for c in labels)).isNotNull())
    found = staged(found.select(F.inline(sure)), "cotraining")
    new = found.join(usable, "doc_id", "left_anti")
    # Copies of a text may differ in metadata; the one with the least id is taken.
    each = new.groupBy("key").agg(
        F.min_by(F.struct("doc_id", *VIEWS, *labels), "doc_id").alias("row")
    )
    return staged(each.select("row.*"), "cotraining")


def fit(documents: DataFrame, labels: DataFrame):
    """Models of both views with their calibrations; None if a class has no rows."""
    given = _sample(documents, labels).withColumn("given", F.lit(True))
    sample = staged(given.repartition(2), "cotraining")
    held = crc_mod("doc_id", CALIBRATION) == 0
    fitted = sample.where(~held)
    if fitted.select("label").distinct().count() < 2:
        return None
    taught = dict.fromkeys(VIEWS, fitted.select("doc_id", "label", "given", *VIEWS))
    usable = _usable(labels)
    for part in range(ROUNDS + 1):
        models = {v: _classifier(v, taught[v]) for v in VIEWS}
        if part == ROUNDS:
            break
        limits = {v: _limits(fitted, v, models[v]) for v in VIEWS}
        new = _exchange(documents, usable, models, limits, part)
        for view, other in (VIEWS, VIEWS[::-1]):
            label = F.col(f"by_{view}").alias("label")
            labelled = new.select("doc_id", label, F.lit(False).alias("given"), *VIEWS)
            taught[other] = taught[other].union(labelled.where("label IS NOT NULL"))
    checked = sample.where(held)
    if checked.select("label").distinct().count() < 2:
        checked = fitted
    curves = {v: _calibration(v, models[v].transform(checked)) for v in VIEWS}
    return models, curves


def _margin(view: str) -> Column:
    return vector_to_array(F.col(f"{view}_raw"))[1]


def _calibration(view: str, scored: DataFrame) -> tuple[float, float]:
    """Slope and constant of the chance's logit over a view's margin."""
    rows = scored.select(_margin(view).alias("margin"), "label", "given")
    rows = VectorAssembler(inputCols=["margin"], outputCol="x").transform(rows)
    curve = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", maxIter=15, regParam=0.02
    ).fit(_weighted(rows))
    # A view whose margin points the wrong way on unseen rows knows nothing.
    slope = float(curve.coefficients[0])
    return (slope, float(curve.intercept)) if slope > 0 else (0.0, 0.0)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the calibrated chance of each view, and both combined.

    Null text, language and source count as empty, null length as 0; repeated rows
    are scored each. If a class has no labelled row, every score is 0.5.
    """
    learned = fit(documents, labels)
    if learned is None:
        half = [F.lit(0.5).alias(c) for c in ("content_score", "metadata_score", "score")]
        return documents.select("doc_id", *half, F.lit(1).alias("predicted"))
    models, curves = learned
    scored = views(documents.select(*COLUMNS))
    logits = {}
    for view in VIEWS:
        scored = models[view].transform(scored)
        slope, constant = curves[view]
        logits[view] = F.lit(slope) * _margin(view) + constant
    # Both curves are fitted with equal weight of the classes, so their logits add.
    chances = {v: 1 / (1 + F.exp(-x)) for v, x in logits.items()}
    both = 1 / (1 + F.exp(-sum(logits.values(), F.lit(0.0))))
    return scored.select(
        "doc_id",
        chances["content"].alias("content_score"),
        chances["metadata"].alias("metadata_score"),
        both.alias("score"),
        (both >= 0.5).cast("int").alias("predicted"),
    )
