"""URL filter: rules first, gradient-boosted trees for the rest.

URLs that a rule judges are the labelled ones. Trees learn from their lexical
features and judge every URL without a rule. Features, labels and scores are
DataFrame expressions; the trees are Spark's own.
"""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged

#: Host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Labelled URLs the trees are fitted on, at most: those with the lowest hash.
FIT_ROWS = 8_000
#: A rate from so many labelled URLs weighs as much as the wider one it is shrunk to:
#: that of suffix and first directory to that of the directory, and so to that of all.
#: The rate of a labelled URL is that of the other folds.
SUFFIX_ROWS, FOLDS = 20, 5
#: Suffixes with this share of the pages or more count as equally common. Which common
#: suffix a page has must not stand in for the rules that judge that suffix.
COMMON_SHARE = 0.01
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "host_labels",
    "hyphens",
    "digit_ratio",
    "host_digit_ratio",
    "entropy",
    "host_entropy",
    "parameters",
    "has_fragment",
    "has_extension",
    "suffix_rate",
    "suffix_share",
)


def parts(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``; null, or without ``://``: both empty."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return pages.select(
        "page_id",
        "url",
        F.translate(host, CAPITALS, SMALL).alias("host"),
        path.alias("path"),
    )


def rule_of(host: Column, path: Column) -> Column:
    """The longest rule that fits, as ``rule, verdict``; null if none does."""
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for name, prefix, verdict in reversed(ordered):
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        named = F.struct(
            F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fits = fits & F.startswith(path, F.lit(prefix))
        chosen = F.when(fits, named).otherwise(chosen)
    return chosen


def _entropy(text: Column) -> Column:
    size = F.greatest(F.length(text), F.lit(1))
    letters = F.array_distinct(F.split(text, ""))
    each = F.transform(
        letters,
        lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size,
    )
    return F.aggregate(
        each,
        F.lit(0.0),
        lambda a, p: a - F.when((p > 0) & (p <= 1), p * F.log2(p)).otherwise(0.0),
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(judged: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    size = F.greatest(F.length(url), F.lit(1))
    return judged.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": _count(path, "/[^/]"),
            "host_labels": _count(host, r"[^.]+"),
            "hyphens": _count(host, "-"),
            "digit_ratio": _count(url, "[0-9]") / size,
            "host_digit_ratio": _count(host, "[0-9]")
            / F.greatest(F.length(host), F.lit(1)),
            "entropy": _entropy(url),
            "host_entropy": _entropy(host),
            "parameters": _count(F.regexp_extract(url, r"\?([^#]*)", 1), "[^&]+"),
            "has_fragment": F.contains(url, F.lit("#")).cast("double"),
            "has_extension": path.rlike(r"\.[a-zA-Z0-9]{1,5}$").cast("double"),
        }
    )


def with_suffixes(ruled: DataFrame) -> DataFrame:
    """``ruled`` with ``suffix_rate`` and ``suffix_share``, each of all its rows.

    The share is that among all pages, up to ``COMMON_SHARE``. The rate is that of
    block among the labelled pages with the suffix and first directory, shrunk to the
    rate of the directory under any suffix and that to the rate of all: a suffix that
    the rules only ever block says nothing about directories that they do not name.
    Without labelled pages it is a half.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    placed = ruled.withColumns(
        {
            "suffix": F.substring_index("host", ".", -1),
            "directory": F.regexp_extract("path", "^(/[^/]*/)", 1),
            "fold": F.pmod(F.xxhash64(url, F.lit("fold")), FOLDS).cast("int"),
        }
    )
    # Written, so that the joins see the sizes: few groups are broadcast, and the
    # join with many can split a common one.
    shares = staged(placed.groupBy("suffix").agg(F.count("*").alias("pages")), "url_filter")
    total = shares.agg(F.sum("pages")).first()[0] or 1
    folds = {f"known_{k}": F.col("fold") == k for k in range(FOLDS)}
    folds |= {f"blocked_{k}": F.col(f"known_{k}") & (F.col("label") == 1) for k in range(FOLDS)}
    known = placed.where(F.col("label").isNotNull())
    for name, condition in folds.items():
        known = known.withColumn(name, condition)
    counts = [F.count_if(F.col(n)).alias(n) for n in folds]
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in folds]
    pairs = staged(known.groupBy("suffix", "directory").agg(*counts), "url_filter")
    wider = staged(pairs.groupBy("directory").agg(*sums), "url_filter")
    whole = wider.agg(*sums).first()

    def packed(groups: DataFrame, name: str) -> DataFrame:
        keys = [c for c in groups.columns if c not in folds]
        return groups.select(*keys, F.struct(*folds).alias(name))

    def others(count) -> tuple[Column, Column]:
        """Blocked and known pages outside the fold of a labelled one."""
        labelled = F.col("label").isNotNull()
        return tuple(
            sum(
                F.when(labelled & (F.col("fold") == k), 0).otherwise(count(f"{kind}_{k}"))
                for k in range(FOLDS)
            )
            for kind in ("blocked", "known")
        )

    blocked, seen = others(lambda n: F.lit(whole[n]))
    rate = (blocked + 0.5) / (seen + 1)
    for name in ("in_directory", "in_pair"):
        blocked, seen = others(lambda n, group=name: F.coalesce(f"{group}.{n}", F.lit(0)))
        rate = (blocked + SUFFIX_ROWS * rate) / (seen + SUFFIX_ROWS)
    return (
        placed.join(shares, "suffix")
        .join(packed(wider, "in_directory"), "directory", "left")
        .join(packed(pairs, "in_pair"), ["suffix", "directory"], "left")
        .withColumns(
            {
                "suffix_rate": rate,
                "suffix_share": F.least(F.col("pages") / total, F.lit(COMMON_SHARE)),
            }
        )
        .drop("suffix", "directory", "fold", "pages", "in_directory", "in_pair")
    )


def fit(described: DataFrame) -> PipelineModel | None:
    """Trees from ``FIT_ROWS`` of the labelled rows.

    Labelled rows of one class only, or none, give no trees; ``judge`` then repeats
    that class, or allows.
    """
    order = [F.xxhash64("url"), "page_id"]
    labelled = described.where(F.col("label").isNotNull())
    sample = labelled.orderBy(*order).limit(FIT_ROWS)
    sample = staged(features(sample).select("label", *FEATURES), "url_filter")
    classes = {r["label"] for r in sample.select("label").distinct().collect()}
    model = None
    if len(classes) == 2:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(
            labelCol="label", maxIter=10, maxDepth=4, seed=7, checkpointInterval=-1
        )
        rows = assembler.transform(sample).coalesce(2)
        model = PipelineModel([assembler, trees.fit(rows.select("features", "label"))])
    return model


def judge(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page.

    ``score`` is the trees' chance of block. Null URLs have empty parts, no rule, and
    are judged by the trees like any other; repeated rows are judged each.
    """
    chosen = rule_of(F.col("host"), F.col("path"))
    ruled = parts(pages).withColumn("chosen", chosen)
    known = (F.col("chosen.verdict") == "block").cast("double")
    placed = with_suffixes(ruled.withColumn("label", known))
    model = fit(placed)
    described = features(placed)
    if model is None:
        scored = described.withColumn("score", F.coalesce("suffix_rate", F.lit(0.0)))
    else:
        chance = vector_to_array("probability")[1]
        scored = model.transform(described).withColumn("score", chance)
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", learned).alias("verdict"),
        "score",
    )
