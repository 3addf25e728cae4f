"""Conversation structure: faults, the cheapest repair, and the repaired turns.

Each row is kept (0), gets another role (1) or is deleted (2, the only choice for
blank and repeated rows); an empty turn can be inserted anywhere (5); a truncated
row that stays costs 5 more. The initials of the roles that are left must spell
``(s?(ua)+)?``. Of the cheapest repairs the one whose edit letters come first in
ASCII order is taken.

Method: the repair is a shortest path through the rows and the four states of that
pattern. A path is one integer: its high digits are the cost, its low digits the
edit letters, the first letter highest, each at a fixed place, zeros behind the last
one. The smaller integer is the better path, so the minimum decides cost and ties at
once. Integers would grow with the conversation, so after ``BLOCK_ROWS`` rows the
letters so far are replaced by their rank among the four states. That keeps every
comparison: prefixes over the same rows end in the letter of the same row, so none
of two different ones continues the other, and their order decides whatever follows.

Scale: digests stand for texts where rows are counted and the first of equal (role,
text) rows is sought, both combined before the shuffle. Texts are shuffled once. A
task streams its conversations in order: first the rows without texts, which settle
the path, then the texts in the same order. It holds the edit letters of one
conversation (which its result has to hold anyway), a byte for each of its rows, and
no texts. One conversation stays in one task, as the digest of its text is sequential.

Odd rows: null text, role, conversation or turn count as one space where the rule
reads them as text; a null turn comes first. Rows of the same turn follow each other
by role, then by SHA-256 of their text. A conversation without rows, or whose every
row is dropped, has zeros, no edits and the digest of an empty text. An empty table
gives no rows. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Letters of the edits in ASCII order, their costs, and the extra
#: cost of a truncated row that stays.
LETTERS = ("", "D", "I", "K", "R")
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5

#: Rows between two renumberings of the letters; any number gives the same result.
BLOCK_ROWS = 32
WIDTH = 2 * BLOCK_ROWS + 2
DIGIT = 3  # bits of a letter
RANK = DIGIT * WIDTH  # place of the rank of the letters before the block
COST = RANK + 2  # place of the cost
LOW = (1 << COST) - 1

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn of that initial, for the initials a state accepts.
NEXT = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
#: What an inserted turn, or a turn given another role, must be in each state.
MADE = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}

SUMMARY = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string, repaired_sha256 string"
)
TURNS = "conv_id {id}, position long, edit string, role string, text string"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that their conversation and turn call for.

    ``copies`` counts how often a row stands there; 0 marks a dropped one.
    """
    space = F.lit(" ")
    place = F.concat_ws(
        ":",
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(place.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _prepared(conversations: DataFrame) -> DataFrame:
    """By conversation its rows without texts, then those that are not blank with them."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    stripped = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    ).select(
        "*",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (stripped == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    marks = (
        rows.filter((F.col("copies") > 0) & ~F.col("blank"))
        .groupBy("conv_id", "role", "digest", "truncated")
        .agg(
            F.min("turn").alias("known"),
            F.max(F.col("turn").isNull()).alias("unknown"),
        )
        .select(
            "conv_id",
            F.when(~F.col("unknown"), F.col("known")).alias("turn"),
            "role",
            "digest",
            F.lit(False).alias("blank"),
            "truncated",
            F.lit(0).cast("long").alias("copies"),
            F.lit(True).alias("first"),
        )
    )
    plain = rows.withColumn("first", F.lit(False))
    light = (
        plain.select(marks.columns)
        .unionByName(marks)
        .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated")
        .agg(F.sum("copies").alias("copies"), F.max("first").alias("first"))
        .select("*", F.lit(None).cast("string").alias("text"), F.lit(0).alias("part"))
    )
    texts = plain.filter((F.col("copies") > 0) & ~F.col("blank")).withColumn(
        "part", F.lit(1)
    )
    return (
        light.unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "turn", "role", "digest")
        .drop("digest", "part")
    )


def _edges(initial: str, truncated: bool) -> list[list[tuple[int, int, int, int]]]:
    """For each state: the state after a row, cost, letters as digits, their number."""
    extra = TRUNCATED_COST if truncated else 0

    def steps(state: int) -> Iterator[tuple[int, int, int]]:
        yield state, DELETE_COST, 1
        if initial in NEXT[state]:
            yield NEXT[state][initial], KEEP_COST + extra, 3
        yield NEXT[state][MADE[state]], ROLE_COST + extra, 4

    found = []
    for state in range(4):
        after = NEXT[state][MADE[state]]
        plain = [(to, cost, digit, 1) for to, cost, digit in steps(state)]
        behind_insert = [
            (to, INSERT_COST + cost, 2 << DIGIT | digit, 2)
            for to, cost, digit in steps(after)
        ]
        found.append(plain + behind_insert)
    return found


EDGES = {(i, t): _edges(i, t) for i in ("s", "u", "a", "") for t in (False, True)}


class Path:
    """The best path into each state, extended row by row.

    Two inserted turns in one gap never pay: deleting what stands before costs less.
    An inserted turn before a row that must go never wins either, as it costs the
    same behind it and D comes before I.
    """

    def __init__(self) -> None:
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        # Letters before the block by rank, each linked to those before them.
        self.stored: list[tuple | None] = [None]
        self.rows = 0

    def row(self, initial: str, truncated: bool) -> None:
        if self.rows == BLOCK_ROWS:
            self._renumber()
        self.rows += 1
        found: list[tuple[int, int] | None] = [None] * 4
        edges = EDGES[initial if initial in ("s", "u", "a") else "", truncated]
        for state, label in enumerate(self.best):
            if label is None:
                continue
            value, used = label
            for to, cost, digits, count in edges[state]:
                place = DIGIT * (WIDTH - used - count)
                new = value + (cost << COST) + (digits << place)
                if found[to] is None or new < found[to][0]:
                    found[to] = (new, used + count)
        self.best = found

    def removed(self, count: int) -> None:
        """Rows that must go: every path gets the same letters."""
        self._renumber()
        self.stored = [(path, "D" * count) for path in self.stored]
        cost = DELETE_COST * count << COST
        self.best = [label and (label[0] + cost, 0) for label in self.best]

    def _renumber(self) -> None:
        """Store the letters of the block and leave their rank in their place."""
        if self.rows == 0:
            return
        live = [state for state, label in enumerate(self.best) if label]
        live.sort(key=lambda state: self.best[state][0] & LOW)
        stored, best = [], [None] * 4
        for rank, state in enumerate(live):
            value, used = self.best[state]
            stored.append(self._with_letters(value, used))
            best[state] = ((value >> COST << COST) + (rank << RANK), 0)
        self.stored, self.best, self.rows = stored, best, 0

    def _with_letters(self, value: int, used: int) -> tuple:
        letters = "".join(
            LETTERS[value >> DIGIT * (WIDTH - 1 - k) & 7] for k in range(used)
        )
        return self.stored[value >> RANK & 3], letters

    def end(self) -> tuple[int, str]:
        """Cost and letters of the best path that ends where the pattern may."""
        ends = []
        for state, label in enumerate(self.best):
            if label is None:
                continue
            value, used = label
            while state in (SYSTEM, USER):
                used += 1
                value += (INSERT_COST << COST) + (2 << DIGIT * (WIDTH - used))
                state = NEXT[state][MADE[state]]
            ends.append((value, used))
        value, used = min(ends)
        path, letters = self._with_letters(value, used), []
        while path is not None:
            path, part = path
            letters.append(part)
        return value >> COST, "".join(reversed(letters))


class Conversation:
    """Faults and repair of one conversation, from its rows in order."""

    def __init__(self) -> None:
        self.turns = 0
        self.first_turn = self.last_turn = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.role = None
        self.path = Path()
        self.gone = bytearray()  # for each row whether it must go; 2: has no text
        self.audit = None

    def row(self, turn, role, blank, truncated, copies, first) -> None:
        """``copies`` equal rows of one turn; ``first`` if none like them came before."""
        if copies == 0:
            return
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        initial = role[:1]
        if self.role is not None:
            self.illegal += self.role + initial not in ("su", "ua", "au")
        self.role = initial
        self.illegal += copies - 1
        stays = not blank and first
        if stays:
            self.truncated += truncated
            self.path.row(initial, truncated)
            self.gone.append(0)
            copies -= 1
        if copies:
            self.path.removed(copies)
            self.gone.extend((b"\2" if blank else b"\1") * copies)
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.path.end()
            self.letter = self.at = 0
            self.state = EMPTY
            self.sha = hashlib.sha256()
            self.written = 0

    def _turn(self, edit: str, role: str, text: str) -> tuple:
        self.state = NEXT[self.state][role[:1]]
        line = f"{role}:{text}"
        self.sha.update(("\n" + line if self.written else line).encode())
        self.written += 1
        return self.written - 1, edit, role, text

    def _made(self) -> str:
        return ROLES[MADE[self.state]]

    def _until_text(self) -> Iterator[tuple]:
        """Inserted turns and blank rows, up to a row with a text."""
        while self.letter < len(self.audit):
            if self.audit[self.letter] == "I":
                yield self._turn("I", self._made(), "")
            elif self.gone[self.at] == 2:
                self.at += 1
            else:
                return
            self.letter += 1

    def text(self, role: str, text: str, copies: int) -> Iterator[tuple]:
        """The turns that the next rows, which share a text, add."""
        self.settle()
        for _ in range(copies):
            yield from self._until_text()
            edit = self.audit[self.letter]
            if edit == "K":
                yield self._turn("K", role, text)
            elif edit == "R":
                yield self._turn("R", self._made(), text)
            self.letter += 1
            self.at += 1

    def rest(self) -> Iterator[tuple]:
        self.settle()
        yield from self._until_text()

    def summary(self) -> tuple:
        known = self.last_turn is not None
        span = self.last_turn - self.first_turn + 1 if known else 0
        return (
            span - self.turns, self.blank, self.duplicate, self.truncated,
            self.illegal, self.cost, self.audit, self.sha.hexdigest(),
        )


NEW = object()


def _streamed(rows: Iterator[dict], turns: bool) -> Iterator[tuple]:
    """Result rows of conversations that follow each other."""
    name, open_one = NEW, None

    def closed() -> Iterator[tuple]:
        rest = list(open_one.rest())
        if turns:
            yield from ((name, *turn) for turn in rest)
        else:
            yield (name, *open_one.summary())

    for row in rows:
        if open_one is None or row["conv_id"] != name:
            if open_one is not None:
                yield from closed()
            name, open_one = row["conv_id"], Conversation()
        if row["text"] is None:
            open_one.row(
                row["turn"], row["role"], row["blank"], row["truncated"],
                row["copies"], row["first"],
            )
        else:
            made = open_one.text(row["role"], row["text"], row["copies"])
            if turns:
                yield from ((name, *turn) for turn in made)
            else:
                for _ in made:
                    pass
    if open_one is not None:
        yield from closed()


def _mapped(conversations: DataFrame, schema: str, turns: bool) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType.simpleString()
    result = _parse_datatype_string(schema.format(id=kind))
    arrow = to_arrow_schema(result)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [
            pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        held, size = [], 0
        for row in _streamed(rows, turns):
            held.append(row)
            size += len(row[7] if not turns else row[4])
            if len(held) == 1000 or size > 8_000_000:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return _prepared(conversations).mapInArrow(run, result)


def repair(conversations: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of the repaired text of each conversation.

    Columns: conv_id, turn, role, text, and copies if rows stand there several times.
    """
    return _mapped(conversations, SUMMARY, turns=False)


def repaired(conversations: DataFrame) -> DataFrame:
    """The turns that the repair leaves, in order, with the edit behind each."""
    return _mapped(conversations, TURNS, turns=True)
