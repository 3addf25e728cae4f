"""Scores of texts under a hidden Markov language model.

Latent states emit token classes and a class emits its tokens. Each of the commonest
tokens is a class of its own, the others share classes by their endings; within a
class, a token's chance follows its count in the training texts. Baum-Welch counts
are summed over partitions, and the scaled forward recursion gives the exact
likelihood of each text.

Texts are encoded once, in chunks of bounded size with a vocabulary of their own:
then only the distinct tokens of a chunk are joined with the counts.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged, texts_of

STATES, ROUNDS = 8, 3
#: Tokens that are classes of their own, and classes that the others share.
COMMON, SHARED = 2000, 256
CLASSES = COMMON + SHARED
ENDING = 3
#: Bytes of text in a chunk; a longer text is a chunk by itself.
CHUNK_BYTES = 7_500_000
#: Tokens whose forward variables are held at a time. A step of the recursion costs
#: about the same for few texts as for hundreds, so groups are large.
GROUP_TOKENS = 600_000
#: Distinct training texts that give the first emissions, at most.
SEED_TEXTS = 1000
#: Weight of the corpus-wide class shares in each state's emissions.
PRIOR = 100.0
#: Texts whose crc32 has this remainder are held out.
MODULUS, HELD_OUT = 7, 2
END = b""

CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, lengths array<int>,"
    " tokens binary, words array<binary>, counts array<int>"
)
CODED = (
    "chunk long, doc_ids array<long>, held array<boolean>, lengths array<int>,"
    " classes binary, within array<double>, base array<double>, known array<long>"
)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _unpacked(content: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(content), kind)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Chunks one by one: a chunk's words are many Python objects."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def held_out(doc_id: int | None) -> bool:
    text = b"" if doc_id is None else str(doc_id).encode()
    return zlib.crc32(text) % MODULUS == HELD_OUT


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    made = (context.partitionId() if context else 0) << 32
    ids, lengths, tokens, size = [], [], [], 0
    words: dict[bytes, int] = {}

    def row() -> pa.RecordBatch:
        held = [held_out(i) for i in ids]
        codes = np.concatenate(tokens)
        # Common words get small numbers, which pack well.
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        ranks = np.empty(len(words), "<i4")
        ranks[order] = np.arange(len(words))
        codes, ordered = ranks[codes], list(words)
        trained = codes[np.repeat(~np.array(held), lengths)]
        counts = np.bincount(trained, minlength=len(words)).astype(np.int32)
        columns = [[made], [ids], [held], [lengths], [_packed(codes)]]
        columns += [[[ordered[i] for i in order.tolist()]], [counts]]
        types = [
            pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
            pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()),
        ]
        names = ["chunk", "doc_ids", "held", "lengths", "tokens", "words", "counts"]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        texts = texts_of(batch.column("text"))
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            if ids and size + len(text) > CHUNK_BYTES:
                yield row()
                made += 1
                ids, lengths, tokens, size, words = [], [], [], 0, {}
            found = text.lower().split()
            found.append(END)
            for word in set(found).difference(words):
                words[word] = len(words)
            codes = np.fromiter(map(words.__getitem__, found), "<i4", len(found))
            ids.append(doc_id)
            lengths.append(len(found))
            tokens.append(codes)
            size += len(text)
    if ids:
        yield row()


@dataclass(frozen=True)
class Vocabulary:
    """What scoring needs besides a token's own count."""

    tokens: int  # N
    distinct: int  # V
    common: dict[bytes, int]
    class_totals: np.ndarray  # training tokens of each class
    class_distinct: np.ndarray  # distinct training tokens of each class

    def shares(self) -> np.ndarray:
        mass = self.class_totals + 1.0
        return mass / mass.sum()


def ending_class(word: bytes) -> int:
    return COMMON + zlib.crc32(word[-ENDING:]) % SHARED


def _ending_class() -> Column:
    """``ending_class`` of the column ``word``."""
    ending = F.substring("word", -ENDING, ENDING)
    ending = F.when(F.length("word") <= ENDING, F.col("word")).otherwise(ending)
    return COMMON + F.crc32(ending) % SHARED


def _coded_words(entries: DataFrame, counts: DataFrame, vocab: "Vocabulary") -> DataFrame:
    """For each chunk the places, counts and classes of its words, in one order.

    The common words are broadcast: ``COMMON`` rows at most.
    """
    common = entries.sparkSession.createDataFrame(
        [(word, number) for word, number in vocab.common.items()],
        "word binary, number int",
    )
    return (
        entries.join(counts, "word", "left")
        .join(F.broadcast(common), "word", "left")
        .select(
            "chunk",
            "place",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce("number", _ending_class()).cast("int").alias("class"),
        )
        .groupBy("chunk")
        .agg(
            F.collect_list("place").alias("places"),
            F.collect_list("count").alias("totals"),
            F.collect_list("class").alias("kinds"),
        )
    )


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From ``word, count`` of all training tokens; what is collected is bounded."""
    seen = counts.where("count > 0")
    totals = seen.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    top = seen.orderBy(F.desc("count"), "word").limit(COMMON).collect()
    common = {bytes(r["word"]): i for i, r in enumerate(top)}
    by_class = seen.groupBy(_ending_class().alias("class"))
    sums = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class.agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect():
        sums[0][r["class"]], sums[1][r["class"]] = r["n"], r["v"]
    for r in top:
        word, number = bytes(r["word"]), common[bytes(r["word"])]
        sums[0][ending_class(word)] -= r["count"]
        sums[1][ending_class(word)] -= 1
        sums[0][number], sums[1][number] = r["count"], 1
    return Vocabulary(totals["n"] or 0, totals["v"], common, *sums)


def _coder(vocab: Vocabulary):
    """Chunks and the counts of their words, to classes and what needs no states."""
    unseen = vocab.tokens + vocab.distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                one = batch.slice(number, 1)
                places, totals, kinds = (
                    one.column(c).flatten().to_numpy() for c in ("places", "totals", "kinds")
                )
                counts, classes = np.zeros(len(places)), np.zeros(len(places), "<u2")
                counts[places], classes[places] = totals, kinds
                same = ("chunk", "doc_ids", "held", "lengths", "tokens")
                row = one.select(same).to_pylist()[0]
                mass = vocab.class_totals[classes] + vocab.class_distinct[classes] + 1
                within = np.where(classes < COMMON, 0.0, np.log10((counts + 1) / mass))
                base = np.log10((counts + 1) / unseen)
                codes = _unpacked(row["tokens"], "<i4")
                starts = np.cumsum(row["lengths"]) - row["lengths"]
                columns = {
                    "classes": [_packed(classes[codes])],
                    "within": [np.add.reduceat(within[codes], starts)],
                    "base": [np.add.reduceat(base[codes], starts)],
                    "known": [np.add.reduceat((counts > 0)[codes].astype(np.int64), starts)],
                }
                kept = {c: [row[c]] for c in same[:-1]}
                yield pa.RecordBatch.from_pydict(kept | columns, schema=_CODED_TYPE)

    return run


_CODED_TYPE = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("classes", pa.binary()),
        ("within", pa.list_(pa.float64())),
        ("base", pa.list_(pa.float64())),
        ("known", pa.list_(pa.int64())),
    ]
)


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # state
    moves: np.ndarray  # state, next state
    emits: np.ndarray  # class, state


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Texts by falling length, in groups of about ``GROUP_TOKENS``."""
    order = np.argsort(-lengths, kind="stable")
    cuts = np.cumsum(lengths[order]) // GROUP_TOKENS
    yield from np.split(order, np.flatnonzero(np.diff(cuts)) + 1)


def _forward(model: Model, classes, starts, lengths):
    """For texts by falling length: classes, scaled forward variables and scales of
    each step, whose first rows are the texts that are still going on."""
    steps = []
    state = None
    going = len(starts)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[going - 1] <= t:
            going -= 1
        seen = classes[starts[:going] + t]
        state = model.start if state is None else state[:going] @ model.moves
        state = state * model.emits[seen]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        steps.append((seen, state, scale))
    return steps


def log_likelihoods(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each text's classes."""
    starts = np.cumsum(lengths) - lengths
    result = np.zeros(len(lengths))
    for group in _groups(lengths):
        for _, state, scale in _forward(model, classes, starts[group], lengths[group]):
            result[group[: len(scale)]] += np.log10(scale)
    return result


def expected_counts(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of starts, moves and emissions, in one row of numbers."""
    starts = np.cumsum(lengths) - lengths
    begun, moved = np.zeros(STATES), np.zeros((STATES, STATES))
    emitted = np.zeros((CLASSES, STATES))
    for group in _groups(lengths):
        steps = _forward(model, classes, starts[group], lengths[group])
        later, ahead = np.ones((0, STATES)), np.ones((0, STATES))
        # Each step's forward variables are replaced by its state probabilities.
        for t in range(len(steps) - 1, -1, -1):
            seen, state, scale = steps[t]
            later = np.ones_like(state)
            if len(ahead):
                later[: len(ahead)] = ahead @ model.moves.T
                moved += state[: len(ahead)].T @ ahead
            if t:
                ahead = model.emits[seen]
                ahead *= later
                ahead /= scale[:, None]
            state *= later
        if steps:
            begun += steps[0][1].sum(axis=0)
            spots = np.concatenate([s for s, _, _ in steps])
            for k in range(STATES):
                weights = np.concatenate([s[:, k] for _, s, _ in steps])
                emitted[:, k] += np.bincount(spots, weights, CLASSES)
    return np.concatenate([begun, (moved * model.moves).ravel(), emitted.ravel()])


def _model(numbers: np.ndarray, shares: np.ndarray) -> Model:
    """Normalised counts, with a little of everything so nothing is impossible."""
    begun = numbers[:STATES] + 1.0
    moved = numbers[STATES : STATES + STATES**2].reshape(STATES, STATES) + 0.1
    emitted = numbers[STATES + STATES**2 :].reshape(CLASSES, STATES)
    emitted = emitted + PRIOR * shares[:, None]
    return Model(
        begun / begun.sum(),
        moved / moved.sum(axis=1, keepdims=True),
        emitted / emitted.sum(axis=0, keepdims=True),
    )


def _trained(row) -> tuple[np.ndarray, np.ndarray]:
    """Classes and lengths of a chunk's training texts."""
    lengths = np.array(row["lengths"], np.int64)
    train = ~np.array(row["held"], bool)
    classes = _unpacked(row["classes"], "<u2")
    return classes[np.repeat(train, lengths)], lengths[train]


def _seeded(coded: DataFrame, shares: np.ndarray) -> Model:
    """First emissions: clusters of a bounded sample of training texts.

    Texts rank by a hash of their classes. A limit that about twice as many as wanted
    stay below leaves the same number of rows at every size of the corpus.
    """
    texts = coded.agg(F.sum(F.size(F.filter("held", lambda held: ~held)))).first()[0] or 0
    limit = min(2**32, 2**32 * 2 * SEED_TEXTS // max(texts, 1) + 1)

    def propose(batches):
        for batch in batches:
            for row in _rows(batch):
                classes, lengths = _trained(row)
                starts = np.cumsum(lengths) - lengths
                orders = [
                    zlib.crc32(classes[a : a + n].tobytes())
                    for a, n in zip(starts, lengths, strict=True)
                ]
                ranks, first = np.unique(orders, return_index=True)
                chosen = first[ranks < limit]
                counts = [
                    np.bincount(classes[starts[i] : starts[i] + lengths[i]], minlength=CLASSES)
                    for i in chosen
                ]
                rows = {
                    "rank": [orders[i] for i in chosen],
                    "counts": [_packed(c.astype("<i4")) for c in counts],
                }
                types = pa.schema([("rank", pa.int64()), ("counts", pa.binary())])
                yield pa.RecordBatch.from_pydict(rows, schema=types)

    columns = coded.select("lengths", "held", "classes")
    proposed = columns.mapInArrow(propose, "rank long, counts binary")
    once = proposed.groupBy("rank").agg(F.min("counts").alias("counts"))
    rows = once.orderBy("rank").limit(SEED_TEXTS).collect()
    counts = np.array([_unpacked(r["counts"], "<i4") for r in rows], float)
    counts = counts.reshape(-1, CLASSES)
    emitted = np.zeros((CLASSES, STATES))
    if len(counts):
        spread = np.sqrt(counts / counts.sum(axis=1, keepdims=True))
        centres = spread[:1]
        while len(centres) < STATES:  # the text farthest from all centres so far
            centres = np.vstack([centres, spread[(spread @ centres.T).max(axis=1).argmin()]])
        for _ in range(10):
            nearest = (spread @ centres.T).argmax(axis=1)
            for k in range(STATES):
                if (nearest == k).any():
                    mean = spread[nearest == k].mean(axis=0)
                    centres[k] = mean / np.linalg.norm(mean)
        for k in range(STATES):
            emitted[:, k] = counts[nearest == k].sum(axis=0)
    stay = 20.0 * np.eye(STATES).ravel()
    return _model(np.concatenate([np.ones(STATES), stay, emitted.ravel()]), shares)


def _improved(coded: DataFrame, model: Model, shares: np.ndarray) -> Model:
    """One round of Baum-Welch over all training texts."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = 0.0
        for batch in batches:
            for row in _rows(batch):
                total = total + expected_counts(shared.value, *_trained(row))
        if isinstance(total, np.ndarray):
            made = {"numbers": [total]}
            types = pa.schema([("numbers", pa.list_(pa.float64()))])
            yield pa.RecordBatch.from_pydict(made, schema=types)

    columns = coded.select("lengths", "held", "classes")
    partial = columns.mapInArrow(run, "numbers array<double>")
    sums = partial.select(F.posexplode("numbers")).groupBy("pos").agg(F.sum("col").alias("n"))
    # As many rows as the model has numbers.
    rows = sums.collect()
    numbers = np.zeros(STATES + STATES**2 + CLASSES * STATES)
    for r in rows:
        numbers[r["pos"]] = r["n"]
    return _model(numbers, shares)


def score(documents: DataFrame) -> DataFrame:
    """``doc_id``, counts, ``base_score`` and ``score`` of every whole text.

    Null and empty texts are one end token; repeated rows are scored each and count
    each. Without training texts every token is unseen; an empty table gives no rows.
    """
    chunks = documents.select("doc_id", "text").mapInArrow(_chunks, CHUNK)
    chunks = staged(chunks, "hmm")
    entries = chunks.select(
        "chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    ).select("chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    counts = entries.groupBy("word").agg(F.sum("n").alias("count"))
    counts = staged(counts.where("count > 0"), "hmm")
    vocab = vocabulary(counts)
    words = _coded_words(entries.drop("n"), counts, vocab)
    # Every chunk has a word, the end token at least.
    joined = chunks.drop("words", "counts").join(words, "chunk")
    coded = staged(joined.mapInArrow(_coder(vocab), CODED), "hmm")
    shares = vocab.shares()
    model = _seeded(coded, shares)
    for _ in range(ROUNDS):
        model = _improved(coded, model, shares)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                lengths = np.array(row["lengths"], np.int64)
                classes = _unpacked(row["classes"], "<u2")
                by_states = log_likelihoods(shared.value, classes, lengths)
                made = {
                    "doc_id": row["doc_ids"],
                    "held_out": row["held"],
                    "n_tokens": lengths,
                    "n_known": row["known"],
                    "base_score": row["base"],
                    "score": by_states + np.array(row["within"]),
                }
                yield pa.RecordBatch.from_pydict(made, schema=_SCORED_TYPE)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long,"
        " base_score double, score double"
    )
    scored = coded.mapInArrow(run, schema)
    return scored.withColumn("train_tokens", F.lit(vocab.tokens).cast("long"))


_SCORED_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
