"""License scan by ordered signature rules, in built-in functions only.

A text becomes its lower-cased words. Phrases are counted by plain string search.
Hundreds of signature rules, each a regular expression over words, are gated by
keywords: only rules whose keyword a text holds are tried on it. Detections have
word intervals; one that lies inside another of the same or higher priority is
suppressed. Words carry their numbers while rules are tried, and intervals are swept
in order, so a text's time grows with its words and detections.
"""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.license_rules import GATE, LEVELS, RULES

#: Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DETECTION_TYPE = (
    "array<struct<rule: int, label: string, priority: int, level: int, weight: double,"
    " start: int, end: int>>"
)
GROUP_TYPE = (
    "map<string, array<struct<keyword: string, rules: array<struct<rule: int, label: string,"
    " priority: int, level: int, weight: double, needs: array<string>, numbered: string>>>>>"
)
#: Detections that the sweep takes between two copies of what it has kept.
SWEEP_BLOCK = 512


def _groups() -> str:
    """The rules by anchor, then by keyword."""
    groups: dict[str, dict[str, list]] = {}
    for rule in RULES:
        groups.setdefault(rule["anchor"], {}).setdefault(rule["keyword"], []).append(rule)
    return json.dumps(
        {
            anchor: [{"keyword": k, "rules": rules} for k, rules in by.items()]
            for anchor, by in groups.items()
        }
    )


def padded(text: Column) -> Column:
    """The words, each with a space of its own at both ends: `` a  b  ``; one space without words."""
    small = F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)
    spaced = F.concat(F.lit(" "), small, F.lit(" "))
    return F.substr(F.regexp_replace(spaced, SEPARATORS, "  "), F.lit(2))


def _word_count(words: Column) -> Column:
    spaces = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return (spaces / 2).cast("long")


def _detections(words: Column) -> Column:
    """Each place of each gated rule, by its start, longer ones first."""

    def has(word: Column) -> Column:
        return F.contains(words, F.concat(F.lit(" "), word))

    def whole(word: Column) -> Column:
        return has(F.concat(word, F.lit(" ")))

    # One pass finds all anchors of the text; only their groups are looked at.
    anchors = F.array_distinct(F.regexp_extract_all(words, F.lit(GATE), F.lit(0)))
    groups = F.from_json(F.lit(_groups()), GROUP_TYPE)
    groups = F.flatten(F.transform(anchors, lambda a: F.try_element_at(groups, F.substr(a, F.lit(2)))))
    rules = F.flatten(F.filter(groups, lambda g: has(g["keyword"]))["rules"])
    gated = F.filter(rules, lambda r: F.forall(r["needs"], whole))
    each = F.split(F.trim(words), "  ")
    numbered = F.transform(each, lambda w, i: F.concat(w, F.lit(":"), i.cast("string")))
    numbered = F.concat(F.lit(" "), F.array_join(numbered, " "), F.lit(" "))

    def places(rule: Column, text: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(text, rule["numbered"], F.lit(0)),
            lambda match: F.struct(
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["level"].alias("level"),
                rule["weight"].alias("weight"),
                _number(F.substring_index(match, " ", 1)).alias("start"),
                (_number(match) + 1).alias("end"),
            ),
        )

    # A lambda's variable holds the numbered words, so they are made once a text.
    found = F.transform(
        F.when(F.size(gated) > 0, F.array(numbered)).otherwise(F.array()),
        lambda text: F.flatten(F.transform(gated, lambda rule: places(rule, text))),
    )
    # Sorted by a leading key that orders as the sweep needs it.
    keyed = F.transform(
        F.flatten(found),
        lambda d: F.struct(
            d["start"].alias("start"), (-d["end"]).alias("to"), (-d["level"]).alias("low"),
            d["rule"].alias("rule"), d.alias("detection"),
        ),
    )
    return F.array_sort(keyed)["detection"].cast(DETECTION_TYPE)


def _number(match: Column) -> Column:
    """What follows the last colon."""
    return F.substring_index(match, ":", -1).cast("int")


def _kept(found: Column) -> Column:
    """Detections that no other suppresses, of those in sweep order.

    One is suppressed inside a longer one of at least its priority, and by a rule of
    higher priority, or a lower number, over the same words. All that could suppress
    it stand before it, so the largest end so far of each level or a higher one
    decides.
    """
    none = F.from_json(F.lit("[]"), DETECTION_TYPE)

    def seen(ends: Column, d: Column) -> Column:
        return F.transform(
            ends, lambda end, i: F.when(i <= d["level"], F.greatest(end, d["end"])).otherwise(end)
        )

    def step(state: Column, d: Column) -> Column:
        free = F.get(state["ends"], d["level"]) < d["end"]
        kept = F.when(free, F.array_append(state["kept"], d)).otherwise(state["kept"])
        return F.struct(
            F.when(free, seen(state["ends"], d)).otherwise(state["ends"]).cast("array<int>").alias("ends"),
            kept.cast(DETECTION_TYPE).alias("kept"),
        )

    def block(state: Column, number: Column) -> Column:
        part = F.slice(found, number * SWEEP_BLOCK + 1, F.lit(SWEEP_BLOCK))
        start = F.struct(state["ends"].alias("ends"), none.alias("kept"))
        done = F.aggregate(part, start.cast(SWEPT_TYPE), lambda s, d: step(s, d).cast(SWEPT_TYPE))
        return F.struct(
            done["ends"].alias("ends"), F.array_append(state["blocks"], done["kept"]).alias("blocks")
        ).cast(BLOCKS_TYPE)

    start = F.struct(
        F.array_repeat(F.lit(-1), LEVELS).alias("ends"),
        F.array().cast(f"array<{DETECTION_TYPE}>").alias("blocks"),
    )
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / SWEEP_BLOCK).cast("int"))
    swept = F.aggregate(blocks, start.cast(BLOCKS_TYPE), block, lambda s: F.flatten(s["blocks"]))
    return F.when(F.size(found) > 1, swept).otherwise(found)


SWEPT_TYPE = f"struct<ends: array<int>, kept: {DETECTION_TYPE}>"
BLOCKS_TYPE = f"struct<ends: array<int>, blocks: array<{DETECTION_TYPE}>>"


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id``, word and phrase counts, labels, score and detections of every text.

    Null and empty texts have no word: no place, empty labels, score 0. Repeated rows
    are scanned each. ``score`` is the chance that at least one detection is right.
    """
    base = documents.select("doc_id", padded(F.col("text")).alias("words"))
    words = F.col("words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        text = " " + phrase.replace(" ", "  ") + " "
        rest = F.replace(words, F.lit(text), F.lit(""))
        number = ((F.length(words) - F.length(rest)) / len(text)).cast("long")
        head = F.substring_index(words, text, 1)
        before = F.substring_index(words, text, -1)
        tail = len(phrase.split()) + _word_count(before)
        counts.append(number)
        firsts.append(F.when(number > 0, _word_count(head)))
        lasts.append(F.when(number > 0, _word_count(words) - tail))
        labels.append(F.when(number > 0, F.lit(label)))
    found = F.when(words.rlike(GATE), _detections(words)).otherwise(
        F.from_json(F.lit("[]"), DETECTION_TYPE)
    )
    scanned = base.select(
        "doc_id",
        _word_count(words).alias("n_words"),
        sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
        found.alias("found"),
    ).withColumn("detections", _kept(F.col("found")))
    doubt = F.aggregate(
        "detections", F.lit(1.0), lambda a, d: a * (1.0 - d["weight"])
    )
    both = F.array_union("base", F.col("detections.label"))
    sure = F.when(F.col("n_base") > 0, 0.3).otherwise(1.0)
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        (1.0 - doubt * sure).alias("score"),
        "detections",
    )
