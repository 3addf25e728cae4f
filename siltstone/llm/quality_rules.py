"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns estimates how often each rule votes which way for good
and for bad documents; the posterior probability of "good" then replaces a filter
in which every rule must pass.
"""

from dataclasses import dataclass
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import map_rows, staged, texts_of

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, n_lines long, n_distinct long, n_capitals long,"
    " n_letters long, n_bare long, n_shouts long"
)


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has more than once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for window in windows:
        (twice if window in seen else seen).add(window)
    starts = [i for i, window in enumerate(windows) if window in twice]
    gaps = sum(min(3, b - a) for a, b in pairwise(starts))
    return gaps + 3


def measure(text: bytes) -> tuple:
    """The numbers the rules look at; an empty text has zeros."""
    words = text.split()
    kept = text.translate(None, SPACES)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (
        len(words),
        len(kept.decode("utf-8", "replace")),
        symbols,
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        len(set(words)),
        len(text) - len(text.translate(None, CAPITALS)),
        len(text) - len(text.translate(None, LETTERS)),
        sum(1 for w in words if w in BARE),
        text.count(b"!!"),
    )


BARE = frozenset({b"|", b"-", b"*", b"#", b"=", b"+", b"/", b"\\", b"~", b">", b"<"})


def measures(documents: DataFrame) -> DataFrame:
    """All columns of the documents, then the measures of every whole text."""
    names = [part.split()[0] for part in MEASURES.split(",")]

    def rows(batch):
        found = [measure(t) for t in texts_of(batch["text"])]
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        return {n: list(c) for n, c in zip(names, columns, strict=True)}

    return map_rows(documents, rows, MEASURES, keep=True)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds and good where ``good`` holds, else abstains."""

    name: str
    bad: str | None = None
    good: str | None = None

    def vote(self) -> Column:
        vote = F.lit(0)
        if self.good:
            vote = F.when(F.expr(self.good), 1).otherwise(vote)
        if self.bad:
            vote = F.when(F.expr(self.bad), -1).otherwise(vote)
        return vote.cast("int").alias(f"vote_{self.name}")


#: Most rules know one kind of bad text and say nothing of the rest; the last
#: three also speak for a text.
RULES = (
    Rule("symbols", bad="n_symbols > 0.25 * n_words"),
    Rule("repeats", bad="n_repeat_words > 0.4 * n_words"),
    Rule("duplicate_lines", bad="n_dup_lines > 3 AND n_dup_lines > 0.3 * n_lines"),
    Rule("capitals", bad="n_capitals > 0.4 * n_letters"),
    Rule("bare_marks", bad="n_bare > 0.12 * n_words"),
    Rule("shouting", bad="n_shouts > 0.15 * n_words"),
    Rule("few_letters", bad="n_letters < 0.6 * word_chars"),
    Rule("word_length", bad="word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule("length", bad="n_words < 50", good="n_words >= 100"),
    Rule("variety", bad="n_distinct < 2.5 * sqrt(n_words)", good="n_distinct > 80"),
    Rule("prose", good="n_symbols + n_bare + n_shouts = 0"),
)

#: Vote of each column in ``VoteModel.chances``.
VOTES = (-1, 1)


@dataclass(frozen=True)
class VoteModel:
    prior: float
    chances: np.ndarray  # rule, class (bad, good), vote

    def quality(self) -> Column:
        """Posterior probability of good, from the ``vote_`` columns.

        An abstention says nothing: a rule for one kind of bad text is silent on
        every other kind as well as on good text.
        """
        logit = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for rule, chance in zip(RULES, self.chances, strict=True):
            vote = F.col(f"vote_{rule.name}")
            bad, good = (float(x) for x in np.log(chance[1] / chance[0]))
            logit = logit + F.when(vote == -1, bad).when(vote == 1, good).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> VoteModel:
    """Expectation-maximisation over vote patterns.

    Starts from rules that fire on a third of bad texts and a fiftieth of good ones.
    The start stays as prior counts worth a hundredth of the corpus, so the classes
    cannot swap and a rule without votes keeps a defined rate.
    """
    prior = 0.8
    start = np.array([[0.3, 0.6], [0.02, 0.8]])
    chances = np.repeat(start[None], len(RULES), axis=0)
    total = counts.sum()
    weight = max(1.0, 0.01 * total)
    stay = weight * np.array([1 - prior, prior])
    hits = np.stack([patterns == v for v in VOTES], axis=2).astype(float)
    for _ in range(rounds if total else 0):
        like = np.einsum("prv,rcv->pc", hits, np.log(chances))
        like += np.log([1 - prior, prior])
        like -= like.max(axis=1, keepdims=True)
        share = np.exp(like)
        share *= counts[:, None] / share.sum(axis=1, keepdims=True)
        sides = share.sum(axis=0)
        votes = np.einsum("pc,prv->rcv", share, hits)
        votes += start * stay[None, :, None]
        chances = np.clip(votes / (sides + stay)[None, :, None], 1e-4, 1 - 1e-4)
        prior = float(np.clip((sides[1] + stay[1]) / (total + weight), 0.01, 0.99))
    return VoteModel(prior, chances)


def learn(numbers: DataFrame) -> VoteModel:
    """Fit on the vote patterns of all documents.

    There are at most three to the number of rules of them, whatever the corpus, and
    only their counts reach the driver.
    """
    names = [f"vote_{rule.name}" for rule in RULES]
    voted = numbers.select(*(rule.vote() for rule in RULES))
    rows = voted.groupBy(names).count().collect()
    patterns = np.array([list(r)[:-1] for r in rows], int).reshape(-1, len(names))
    return fit(patterns, np.array([r["count"] for r in rows], float))


def judged(numbers: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Measured documents with votes, ``quality``, ``base_failed`` and ``kept``."""
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return (
        numbers.select("*", *(rule.vote() for rule in RULES))
        .withColumn("quality", model.quality())
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= threshold))
    )


def judge(documents: DataFrame) -> DataFrame:
    """Measures, votes, posterior quality and verdict of every document.

    Null text has no words and fails; repeated rows are judged each; an empty table
    gives no rows.
    """
    numbers = staged(measures(documents.select("doc_id", "text")).drop("text"), "quality")
    return judged(numbers, learn(numbers))


def filtered(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    texts = documents.select(F.col("text"))
    model = learn(measures(texts).drop("text"))
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("llm_row")
    numbers = measures(documents.select("text", whole))
    return judged(numbers, model).where("kept").select("llm_row.*")
