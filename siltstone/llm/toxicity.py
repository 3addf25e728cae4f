"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows that mark toxic texts and one
on windows of ordinary texts. A window's distance is the number of bytes by which
the toxic dictionary compresses it better; a text is described by its largest
distance and by how many windows lie beyond a threshold, and a logistic curve fitted
on labelled texts turns that into a probability.

Windows are single words, so one marked word in a long text is not averaged away.
The library's own dictionary trainer samples segments and loses most windows of a
few bytes; a dictionary here holds the chosen windows whole, the commonest last.
"""

import zlib
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import crc_mod, folded_words, map_rows, staged, texts_of

#: Labelled rows of each class that the model is fitted on, at most; the rows with
#: the lowest hash of their id are taken.
FIT_ROWS = 20_000
#: Distinct windows of each class that a dictionary is trained on, at most.
FIT_WINDOWS = 6_000
#: A window marks toxic texts if it is in so many of the distinct ones, in such a
#: share of them, and so many times as often as in ordinary ones.
MIN_TEXTS, MIN_RATE, MIN_RATIO = 4, 0.006, 8.0
DICTIONARY_BYTES = 32 * 1024
CACHED_WINDOWS = 300_000
#: Stands before every window and ends both dictionaries. It costs the same in both;
#: without it zstandard would store a window of a few bytes as it is.
ANCHOR = bytes(range(160, 224))
#: Windows are compressed at the first level; those whose distance there is at least
#: ``SUSPECT`` are measured at the second, which finds the shortest form and takes
#: seven times as long. All others have distance 0.
LEVELS, SUSPECT = (9, 19), 3
#: Distance of a text without windows; windows beyond the threshold that count.
LEAST, COUNTED = -20, 8
#: Fitted rows that agree in all hashes of some band are compared; those that share
#: so much of their word pairs (Jaccard) are copies.
BANDS, BAND_HASHES, COPY_SIMILARITY = 16, 3, 0.5

def _dictionary(samples: list[tuple[bytes, int]]) -> bytes:
    ordered = [w for w, _ in sorted(samples, key=lambda s: (s[1], s[0]))]
    content = b"".join(b" " + w for w in ordered) + b" "
    return content[-DICTIONARY_BYTES:] + ANCHOR


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    # Without header fields, so a length is that of the window alone.
    params = zstandard.ZstdCompressionParameters.from_level(
        level,
        source_size=100 if level == LEVELS[1] else 0,
        dict_size=len(content) if level == LEVELS[1] else 0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    data = zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


@dataclass(frozen=True)
class Distances:
    """The contents of the two dictionaries."""

    toxic: bytes
    ordinary: bytes

    def measurer(self):
        """For one task: the distances of a set of windows."""
        pairs = [
            (_compressor(self.ordinary, level), _compressor(self.toxic, level))
            for level in LEVELS
        ]
        known: dict[bytes, int] = {}

        def distance(window: bytes) -> int:
            padded = ANCHOR + b" " + window + b" "
            gap = 0
            for ordinary, toxic in pairs:
                gap = len(ordinary.compress(padded)) - len(toxic.compress(padded))
                if gap < SUSPECT:
                    return 0
            return gap

        def of(found: set[bytes]) -> list[int]:
            if len(known) > CACHED_WINDOWS:
                known.clear()
            for window in found.difference(known):
                known[window] = distance(window)
            return [known[w] for w in found]

        return of


@dataclass(frozen=True)
class ToxicityModel:
    distances: Distances
    threshold: int
    weights: tuple[float, float, float]
    #: Ordinary and toxic rows that it was fitted on, without copies.
    rows: tuple[int, int]

    def probability(self, top: np.ndarray, beyond: np.ndarray) -> np.ndarray:
        constant, *slopes = self.weights
        x = constant + _features(top, beyond, self.threshold) @ np.array(slopes)
        return 1 / (1 + np.exp(-x))


def _features(top: np.ndarray, beyond: np.ndarray, threshold: int) -> np.ndarray:
    return np.column_stack([np.clip(top - threshold, -3, 3), np.log1p(beyond)])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge; classes weigh the same."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    ridge = np.diag([1e-6, 1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = (x * (share * p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(step, x.T @ (share * (y - p)) - ridge @ w)
    return w


def labelled(documents: DataFrame, labels: DataFrame, held_out: int) -> DataFrame:
    """``text, toxic`` of the rows the model is fitted on (``FIT_ROWS`` a class)."""
    usable = labels.where(crc_mod("doc_id", held_out) != 0).where("toxic IN (0, 1)")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [
        usable.where(F.col("toxic") == c).orderBy(*order).limit(FIT_ROWS)
        for c in (0, 1)
    ]
    # At most 2 * FIT_ROWS pairs of numbers.
    chosen = F.broadcast(picked[0].union(picked[1]))
    return documents.select("doc_id", "text").join(chosen, "doc_id")


def _fitted_rows(sample: DataFrame) -> DataFrame:
    """``toxic, windows`` of the fitted rows, near copies taken once.

    Hundreds of copies of one text would make its own words look like marks. In each
    band, rows with the same hashes are compared with the first of them; a row is a
    copy if it has its class and shares ``COPY_SIMILARITY`` of its word pairs.
    """

    def rows(batch):
        words = [folded_words(t) for t in texts_of(batch["text"])]
        pairs = [_pair_numbers(w) for w in words]
        return {
            "toxic": batch["toxic"],
            "windows": [sorted(set(w)) for w in words],
            "pairs": pairs,
            "bands": [_bands(p) for p in pairs],
        }

    schema = "toxic int, windows array<binary>, pairs array<long>, bands array<long>"
    each = map_rows(sample.select("text", F.col("toxic").cast("int")), rows, schema)
    each = staged(each.withColumn("row", F.monotonically_increasing_id()), "toxicity")
    banded = each.select("row", "toxic", F.posexplode("bands").alias("band", "hash"))
    key = ["toxic", "band", "hash"]
    firsts = banded.groupBy(*key).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # Written, so that the join with a hash of many rows can be split.
    firsts = staged(firsts.where("n > 1").drop("n"), "toxicity")
    like = banded.join(firsts, key).where("row > first").select("row", "first")
    like = staged(staged(like, "toxicity").distinct(), "toxicity")
    of_first = each.select(F.col("row").alias("first"), F.col("pairs").alias("others"))
    both = like.join(each.select("row", "pairs"), "row").join(of_first, "first")
    shared = F.size(F.array_intersect("pairs", "others"))
    either = F.size("pairs") + F.size("others") - shared
    copies = both.where(shared >= COPY_SIMILARITY * either).select("row")
    copies = staged(copies, "toxicity")
    return each.join(copies, "row", "left_anti").select("toxic", "windows")


def _pair_numbers(words: list[bytes]) -> list[int]:
    """A number for each distinct word pair, or one for the text if it has none."""
    pairs = {zlib.crc32(a + b" " + b) for a, b in pairwise(words)}
    return sorted(pairs or {zlib.crc32(b"".join(words))})


def _bands(pairs: list[int]) -> list[int]:
    rng = np.random.default_rng(11)
    factors, terms = rng.integers(1, 2**31, (2, BANDS * BAND_HASHES), np.uint64)
    least = np.full(BANDS * BAND_HASHES, 2**32, np.uint64)
    for start in range(0, len(pairs), 4096):
        values = np.array(pairs[start : start + 4096], np.uint64)[:, None]
        hashed = (values * factors + terms) % np.uint64(4294967291)
        least = np.minimum(least, hashed.min(axis=0))
    return [zlib.crc32(x.tobytes()) for x in least.reshape(BANDS, BAND_HASHES)]


def _window_counts(each: DataFrame) -> DataFrame:
    return (
        each.select("toxic", F.explode("windows").alias("window"))
        .groupBy("window")
        .agg(
            F.sum("toxic").alias("in_toxic"),
            F.sum(1 - F.col("toxic")).alias("in_ordinary"),
        )
    )


def fit(documents: DataFrame, labels: DataFrame, held_out: int = 5) -> ToxicityModel:
    """Learn from the labelled rows whose crc32(doc_id) mod ``held_out`` is not 0.

    Rows whose label is null, or missing, teach nothing. Without toxic rows, or
    without ordinary ones, every score is 0, or 1.
    """
    each = staged(_fitted_rows(labelled(documents, labels, held_out)), "toxicity")
    sizes = dict.fromkeys((0, 1), 0) | {
        r["toxic"]: r["count"] for r in each.groupBy("toxic").count().collect()
    }
    if not all(sizes.values()):
        sure = 30.0 if sizes[1] else -30.0
        nothing = Distances(_dictionary([]), _dictionary([]))
        return ToxicityModel(nothing, 99, (sure, 0.0, 0.0), (sizes[0], sizes[1]))
    counts = staged(_window_counts(each), "toxicity")
    rate = F.col("in_toxic") / sizes[1]
    base = (F.col("in_ordinary") + 0.5) / sizes[0]
    in_toxic = (F.col("in_toxic") >= MIN_TEXTS) & (rate >= MIN_RATE)
    marks = _commonest(counts.where(in_toxic & (rate > MIN_RATIO * base)), "in_toxic")
    common = _commonest(counts.where("in_ordinary > 0"), "in_ordinary")
    distances = Distances(_dictionary(marks), _dictionary(common))

    def rows(batch):
        measure = distances.measurer()
        found = (measure(set(w)) for w in batch["windows"].to_pylist())
        tops = [sorted(d, reverse=True)[:COUNTED] for d in found]
        return {"toxic": batch["toxic"], "tops": tops}

    # At most 2 * FIT_ROWS rows of COUNTED numbers.
    found = map_rows(each, rows, "toxic int, tops array<int>").toPandas()
    y = found["toxic"].to_numpy(float)
    top = np.array([t[0] if len(t) else LEAST for t in found["tops"]], float)

    def parted(t: int) -> float:
        return (top >= t)[y == 1].mean() - (top >= t)[y == 0].mean()

    best = max(range(1, 16), key=parted)
    beyond = np.array([sum(x >= best for x in t) for t in found["tops"]], float)
    weights = _logistic(_features(top, beyond, best), y)
    fitted = sizes[0], sizes[1]
    return ToxicityModel(distances, best, tuple(float(w) for w in weights), fitted)


def _commonest(counts: DataFrame, column: str) -> list[tuple[bytes, int]]:
    top = counts.orderBy(F.desc(column), "window").limit(FIT_WINDOWS)
    return [(bytes(r["window"]), r[column]) for r in top.collect()]


def score(documents: DataFrame, model: ToxicityModel, held_out: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted, top, beyond`` of every document.

    Whole texts are read. Null and empty texts have no window and get the score of
    the smallest distance; repeated rows are scored each.
    """
    return scored(documents.select("doc_id", "text"), model).select(
        "doc_id",
        (crc_mod("doc_id", held_out) == 0).alias("held_out"),
        F.col("llm_score").alias("score"),
        (F.col("llm_score") >= 0.5).cast("int").alias("predicted"),
        F.col("llm_top").alias("top"),
        F.col("llm_beyond").alias("beyond"),
    )


def scored(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of the documents, then ``llm_top, llm_beyond, llm_score``."""
    held: list = []  # one measurer for each task, with the windows it knows

    def rows(batch):
        if not held:
            held.append(model.distances.measurer())
        each = [held[0](set(folded_words(t))) for t in texts_of(batch["text"])]
        top = [max(d, default=LEAST) for d in each]
        beyond = [min(COUNTED, sum(x >= model.threshold for x in d)) for d in each]
        chance = model.probability(np.array(top, float), np.array(beyond, float))
        return {"llm_top": top, "llm_beyond": beyond, "llm_score": chance}

    schema = "llm_top int, llm_beyond int, llm_score double"
    return map_rows(documents, rows, schema, keep=True)


def filtered(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that are likelier ordinary, with their own columns only."""
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("llm_row")
    found = scored(documents.select("text", whole), model)
    return found.where("llm_score < 0.5").select("llm_row.*")
