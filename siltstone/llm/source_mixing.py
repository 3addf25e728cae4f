"""Mix sources to target weights: every source takes its share of all words.

Sources in order of their name (null last) weigh 1, 2, 3, 1, ... and share all words
by weight; a target stops at ``CAP`` times the words of its source, and what is over
goes to the others by weight until no target is above. A source takes its documents
in whole epochs as long as the target holds them all; what remains is selected by
Efraimidis-Spirakis sampling: each document draws an exponential key, divided by its
quality weight, and the smallest keys win until their words reach the remainder. The
document at the edge gives only the words that are missing, so a source takes its
target, rounded to a whole word.

Draws are hashes of id and text, so reruns agree. The quality weight of a document
grows with its length and falls with the share of symbols that markup and code leave.

Scale: documents are read once into narrow rows (id, source, size, key). Keys fall
into ``BUCKETS`` buckets in order, and sums by source and bucket, combined before the
shuffle, show which buckets are in, which are out, and which single one holds the
edge. Only the documents of these edge buckets are sorted, so no source, however
large, is sorted or windowed as a whole. The join is on source and bucket, which
spreads a large source. Only built-in functions are used.

Odd rows: a null text has no words; documents without words take none. A null source
is a source of its own. Equal rows share a key, and which of them lies at the edge
does not change the set of results. Without words every target is 0. An empty table
gives no rows. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import staged

WEIGHTS = (1, 2, 3)
CAP = 3
#: Ranges of the keys of a source; the edge range holds about 1 in so many of its rows.
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_QUALITY = 0.05


def quality_weight(text: Column, size: Column) -> Column:
    """Between ``LEAST_QUALITY`` and 1."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    words = size.cast("double")
    rest = F.greatest(words + symbols, F.lit(1.0))
    return F.greatest(F.lit(LEAST_QUALITY), words / (words + 20.0) * (words / rest))


def _rows(documents: DataFrame) -> DataFrame:
    """Id, source, size, key and bucket of every document."""
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(
        F.concat_ws(
            ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)
        )
    )
    # 52 bits and a half, so neither 0 nor 1.
    drawn = (F.conv(F.substring("digest", 1, 13), 16, 10).cast("long") + 0.5) / 2.0**52
    return (
        documents.select(
            "doc_id",
            "source",
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            text.alias("text"),
            digest.alias("digest"),
        )
        .select(
            "doc_id",
            "source",
            "size",
            "digest",
            (-F.log(drawn) / quality_weight(F.col("text"), F.col("size"))).alias("key"),
        )
        .withColumn(
            "bucket", F.floor(F.col("key") / (F.col("key") + 1.0) * BUCKETS).cast("int")
        )
    )


def _in_order(sources: DataFrame) -> DataFrame:
    """Adds ``place``, the place of a source among all, from 0, nulls last.

    Ranges are written once, so their numbers hold; one row per range is summed up.
    """
    by_name = F.col("source").asc_nulls_last()
    dealt = staged(
        sources.repartitionByRange(by_name).withColumn("range", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("range")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    number = F.row_number().over(Window.partitionBy("range").orderBy(by_name))
    return (
        dealt.withColumn("number", number)
        .join(starts, "range")
        .select("source", "source_size", (F.col("start") + F.col("number") - 1).alias("place"))
    )


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size).

    The level at which targets stop rises with every source found above its cap, so
    the loop ends; each turn brings three sums to the driver.
    """
    weigh = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]),
        (F.col("place") % len(WEIGHTS) + 1).cast("int"),
    )
    weighed = staged(_in_order(sources).withColumn("weight", weigh), "weights")
    cap = F.col("source_size") * CAP

    sums = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = sums[0] or 0, sums[1] or 1
    words, capped = total, 0
    while True:
        # Below 2^31 a literal is an int, and its product with a weight may not fit one.
        share = F.lit(words).cast("long") * F.col("weight") / F.lit(weights)
        above = cap < share
        found = weighed.agg(
            F.count_if(above),
            F.sum(F.when(above, cap)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if found[0] == capped:
            break
        capped, words, weights = found[0], total - found[1], found[2]
    return weighed.select(
        "source",
        "source_size",
        F.when(above, cap.cast("double")).otherwise(share).alias("target"),
    )


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    rows = staged(_rows(documents), "sizes")
    sums = staged(
        rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets"
    )
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sources)

    budget = F.floor(F.col("target") + 0.5).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    before = Window.partitionBy("source").orderBy("bucket")
    buckets = staged(
        sums.withColumn("upto", F.sum("words").over(before))
        .withColumnRenamed("source", "of")
        .join(plan, F.col("of").eqNullSafe(F.col("source")))
        .select(
            "of",
            F.col("bucket").alias("ranked"),
            (F.col("upto") - F.col("words")).alias("from"),
            "upto",
            "source_size",
            "target",
            F.floor(budget / size).cast("long").alias("epochs"),
            (budget % size).alias("rest"),
        ),
        "plan",
    )
    edge = (F.col("from") < F.col("rest")) & (F.col("rest") < F.col("upto"))
    place = F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("ranked"))

    def result(found: DataFrame, selected: Column) -> DataFrame:
        taken = F.col("size") * F.col("epochs") + selected
        return found.select(
            "doc_id", "size", "source_size", "target", taken.alias("taken")
        )

    whole = F.when(F.col("upto") <= F.col("rest"), F.col("size")).otherwise(0)
    in_order = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", "doc_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.col("from") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    missing = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - earlier))
    settled = rows.join(buckets.filter(~edge), place)
    cut = rows.join(buckets.filter(edge), place)
    return result(settled, whole).unionByName(result(cut, missing))
