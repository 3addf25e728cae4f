"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are the indexed documents and every passage of every training text
is a query. Impacts are divided by the item's score for its own words, so a score is
the share of the item's BM25 weight that the passage covers and one threshold serves
all items. Retrieved items are verified by their five-word shingles, in the question
and in the answer.
"""

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import folded_words, map_rows, texts_of

K1, B = 1.2, 0.75
#: Share of an item's BM25 weight from which a passage retrieves it.
THRESHOLD = 0.6
#: Share of an item's shingles that a leak has at least, and of each of its parts.
OVERLAP, PART_OVERLAP = 0.8, 0.5
SHINGLE = 5
#: Passages start every so many words, or as many as the longest item has, and are
#: twice as long, so every item fits into one.
STRIDE = 64
POSTINGS = 64
#: One index holds at most so many items and bytes of text; more items are several
#: indexes, each of which sees every passage.
INDEX_ITEMS, INDEX_BYTES = 20_000, 8_000_000


@dataclass(frozen=True)
class Item:
    item_id: int
    words: list[bytes]
    question: int  # words of the question

    def shingles(self) -> tuple[set, set]:
        question, answer = self.words[: self.question], self.words[self.question :]
        return _shingles(question), _shingles(answer)


def _shingles(words: list[bytes]) -> set:
    """Five words in a row; all words, if there are fewer; none without words."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE)), strict=False))


def item_of(item_id: int, text: bytes) -> Item:
    """Question: up to the last question mark, else all sentences but the last."""
    stripped = text.rstrip(b" \t\r\n.!?")
    cut = text.rfind(b"?") + 1
    if not cut or not folded_words(text[cut:]):
        cut = max(stripped.rfind(mark) for mark in (b". ", b".\n", b"\n")) + 1
    return Item(item_id, folded_words(text), len(folded_words(text[:cut])))


class Index:
    """Postings of one block of items, with the largest impact of each block."""

    def __init__(self, items: list[Item], frequency: dict[bytes, int], total: int, mean: float):
        self.items = items
        self.longest = max((len(i.words) for i in items), default=0)
        self.terms: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for number, item in enumerate(items):
            counts = Counter(item.words)
            norm = K1 * (1 - B + B * len(item.words) / max(mean, 1e-9))
            impacts = {
                t: math.log(1 + (total - frequency[t] + 0.5) / (frequency[t] + 0.5))
                * n
                * (K1 + 1)
                / (n + norm)
                for t, n in counts.items()
            }
            own = sum(impacts.values())
            for term, impact in impacts.items():
                at = self.terms.setdefault(term, len(self.terms))
                if at == len(postings):
                    postings.append([])
                postings[at].append((number, impact / own))
        self.numbers = [[n for n, _ in p] for p in postings]
        self.impacts = [[x for _, x in p] for p in postings]
        self.most = np.array([max(x) for x in self.impacts] + [0.0])
        self.block_most = [
            [max(x[i : i + POSTINGS]) for i in range(0, len(x), POSTINGS)]
            for x in self.impacts
        ]
        self.shingles = [item.shingles() for item in items]
        self._essential()

    def retrieve(self, terms: list[int]) -> dict[int, float]:
        """Items with at least ``THRESHOLD``, by block-max WAND.

        Lists are kept in order of their next item. The pivot is the first list at
        which the largest impacts add up to the threshold; the items before it are
        skipped, and the pivot's item is scored only if the largest impacts of the
        blocks it lies in reach the threshold too.
        """
        lists = [[self.numbers[t][0], 0, t] for t in terms]
        found: dict[int, float] = {}
        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for at, (_, _, term) in enumerate(lists):
                bound += self.most[term]
                if bound >= THRESHOLD:
                    pivot = at
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            head = lists[: pivot + 1]
            blocks = 0.0
            for entry in head:
                self._skip(entry, item)
                if entry[0] == item:
                    blocks += self.block_most[entry[2]][entry[1] // POSTINGS]
            if blocks >= THRESHOLD:
                score = sum(self.impacts[t][at] for n, at, t in head if n == item)
                if score >= THRESHOLD - 1e-9:
                    found[item] = score
            for entry in head:
                if entry[0] == item:
                    self._skip(entry, item + 1)
            lists = [entry for entry in lists if entry[0] < len(self.items)]
        return found

    def _skip(self, entry: list, item: int) -> None:
        """Move a list on to its first posting from ``item`` on."""
        number, at, term = entry
        numbers = self.numbers[term]
        while number < item:
            at += 1
            number = numbers[at] if at < len(numbers) else len(self.items)
        entry[0], entry[1] = number, at

    def _essential(self) -> None:
        """Part the terms so that common ones alone reach half the threshold nowhere.

        ``rest`` is what the common terms give each item at most. Postings of the
        others are laid out flat.
        """
        sizes = np.array([len(n) for n in self.numbers] + [0], np.int64)
        flat = np.array([n for p in self.numbers for n in p], np.int64)
        impacts = np.array([x for p in self.impacts for x in p])
        terms = np.repeat(np.arange(len(sizes)), sizes)
        most = 0
        for most in [0, *sorted(set(sizes.tolist()))]:
            common = sizes[terms] > most
            self.rest = np.bincount(flat[common], impacts[common], len(self.items))
            if self.rest.max(initial=0.0) <= THRESHOLD / 2:
                break
        self.is_essential = (sizes > 0) & (sizes <= most)
        self.sizes, self.flat, self.weights = sizes, flat, impacts
        self.begins = np.cumsum(sizes) - sizes

    def passages(self, words: list[bytes]):
        """Starts, ends and terms of the passages in which an item can reach the
        threshold: by its essential terms that are there and all its common ones."""
        get, none = self.terms.get, len(self.terms)
        terms = np.array([get(w, none) for w in words], np.int64)
        stride = max(STRIDE, self.longest)
        starts = np.arange(0, max(1, len(words) - stride), stride)
        places = np.flatnonzero(self.is_essential[terms])
        # A word lies in the passage that starts before it and in the one before.
        last = np.minimum(places // stride, len(starts) - 1)
        before = places // stride - 1
        inside = before >= 0
        inside &= before < last
        pairs = np.concatenate(
            [last * (none + 1) + terms[places], (before * (none + 1) + terms[places])[inside]]
        )
        passage, term = np.divmod(np.unique(pairs), none + 1)
        sizes = self.sizes[term]
        spots = np.repeat(self.begins[term] - (np.cumsum(sizes) - sizes), sizes)
        spots += np.arange(len(spots))
        keys = np.repeat(passage, sizes) * len(self.items) + self.flat[spots]
        keys, inverse = np.unique(keys, return_inverse=True)
        sums = np.bincount(inverse, self.weights[spots], len(keys))
        bounds = sums + self.rest[keys % len(self.items)]
        for at in np.unique(keys[bounds >= THRESHOLD - 1e-9] // len(self.items)):
            a = int(starts[at])
            b = min(a + 2 * stride, len(words))
            found = set(terms[a:b].tolist())
            found.discard(none)
            yield a, b, found

    def leaks(self, text: bytes) -> list[dict]:
        """Verified items of a text, each with its best passage."""
        words = folded_words(text)
        best: dict[int, dict] = {}
        for a, b, terms in self.passages(words) if words and self.items else ():
            found = self.retrieve(sorted(terms))
            if not found:
                continue
            runs = {
                n: set(zip(*(words[a + i : b] for i in range(n)), strict=False))
                for n in self._sizes(found)
            }
            for number, score in found.items():
                shares = [
                    (sum(s in runs[len(s)] for s in part), len(part))
                    for part in self.shingles[number]
                ]
                hits, total = (sum(x) for x in zip(*shares, strict=True))
                parts = [h / n if n else 1.0 for h, n in shares]
                if not total or hits < OVERLAP * total or min(parts) < PART_OVERLAP:
                    continue
                leak = {
                    "item_id": self.items[number].item_id,
                    "score": score,
                    "question_overlap": parts[0],
                    "answer_overlap": parts[1],
                    "first_word": a,
                }
                if number not in best or hits > best[number]["hits"]:
                    best[number] = leak | {"hits": hits}
        return [best[n] for n in sorted(best)]

    def _sizes(self, found) -> set[int]:
        return {len(s) for n in found for part in self.shingles[n] for s in part}


LEAK = (
    "array<struct<item_id: long, score: double, question_overlap: double,"
    " answer_overlap: double, first_word: int>>"
)


def _indexes(benchmark: DataFrame) -> list[Index]:
    """One index for each block of items; rows without words, or an id, index nothing."""
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL")
    rows = rows.where("length(trim(text)) > 0")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, -(-size["n"] // INDEX_ITEMS), -(-(size["b"] or 0) // INDEX_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    indexes = []

    def counted(batch):
        words = [folded_words(t) for t in texts_of(batch["text"])]
        return {"terms": [sorted(set(w)) for w in words], "n": [len(w) for w in words]}

    terms = map_rows(rows.select("text"), counted, "terms array<binary>, n long")
    totals = terms.agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    counts = terms.select(F.explode("terms").alias("term")).groupBy("term").count()
    for number in range(blocks):
        # A block has INDEX_ITEMS items and INDEX_BYTES of text, about.
        part = rows.where(block == number).orderBy("item_id", "text").collect()
        items = [item_of(r["item_id"], r["text"].encode()) for r in part]
        items = [i for i in items if i.words]
        own = {w for i in items for w in i.words}
        if blocks > 1:
            here = rows.sparkSession.createDataFrame([(bytearray(w),) for w in own], "term binary")
            kept = counts.join(here, "term", "left_semi").collect()
        else:
            kept = counts.collect()
        frequency = {bytes(r["term"]): r["count"] for r in kept}
        indexes.append(Index(items, frequency, totals["n"], totals["mean"] or 0.0))
    return indexes


def flagged(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the documents, then ``llm_leaks``, a list of verified items."""
    spark = documents.sparkSession
    result = documents
    names = []
    for number, index in enumerate(_indexes(benchmark)):
        shared = spark.sparkContext.broadcast(index)
        name = f"llm_leaks_{number}"
        names.append(name)

        def rows(batch, shared=shared, name=name):
            found = [shared.value.leaks(t) for t in texts_of(batch["text"])]
            return {name: [[{k: v for k, v in x.items() if k != "hits"} for x in f] for f in found]}

        result = map_rows(result, rows, f"{name} {LEAK}", keep=True)
    return result.withColumn("llm_leaks", F.concat(*names)).drop(*names)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id``, score and overlaps of every leaked test item.

    Null and empty texts leak nothing; repeated rows are searched each; without test
    items, or documents, there are no rows.
    """
    found = flagged(documents.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("llm_leaks").alias("leak")).select(
        "doc_id", "leak.*"
    )


def filtered(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with their own columns only."""
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("llm_row")
    found = flagged(documents.select("text", whole), benchmark)
    return found.where(F.size("llm_leaks") == 0).select("llm_row.*")
