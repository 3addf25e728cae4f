"""Conversation repair against exhaustive search and SQL, on small odd tables."""

import hashlib
import random

import duckdb
import pyarrow as pa
import pytest
from compare import difference, sql_rows

from siltstone.llm import conversation_repair
from siltstone.llm.oracles import ORACLES

SCHEMA = "conv_id long, turn long, role string, text string, copies_of string, first int"
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """Cost and letters by trying all edits; rows are (initial, must go, truncated)."""
    found = []
    bound = [2 * len(rows)]

    def extend(i, state, cost, letters, inserted):
        if cost > bound[0]:
            return
        if i == len(rows) and state in ("", "a"):
            bound[0] = min(bound[0], cost)
            found.append((cost, letters))
        made = [x for x in AFTER[state] if x != "s"]
        if inserted < 2:
            for x in made:
                extend(i, x, cost + 5, letters + "I", inserted + 1)
        if i == len(rows):
            return
        initial, gone, truncated = rows[i]
        extend(i + 1, state, cost + 2, letters + "D", 0)
        if not gone:
            stays = cost + 5 * truncated
            if initial in AFTER[state]:
                extend(i + 1, initial, stays, letters + "K", 0)
            for x in made:
                extend(i + 1, x, stays + 1, letters + "R", 0)

    extend(0, "", 0, "", 0)
    return min(found)


@pytest.mark.parametrize("block", [1, 2, 32])
def test_path_equals_all_edits(monkeypatch, block):
    width = 2 * block + 2
    rank = conversation_repair.DIGIT * width
    for name, value in (
        ("BLOCK_ROWS", block), ("WIDTH", width), ("RANK", rank),
        ("COST", rank + 2), ("LOW", (1 << rank + 2) - 1),
    ):
        monkeypatch.setattr(conversation_repair, name, value)
    rng = random.Random(block)
    for _ in range(300):
        rows = [
            (rng.choice("ssuuuaaax"), rng.random() < 0.2, rng.random() < 0.3)
            for _ in range(rng.randrange(8))
        ]
        path = conversation_repair.Path()
        for initial, gone, truncated in rows:
            if gone:
                path.removed(1)
            else:
                path.row(initial, truncated)
        assert path.end() == cheapest(rows), rows


def odd_conversations():
    rng = random.Random(8)
    roles = ["user", "assistant", "system", None, "", "tool", "usher"]
    texts = [None, "", " \t\x0b", "Fine.", "cut off", "Why? ", "wait! \n", "ü…", "a.\x1c"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            shown = None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 3])
            rows.append((conv, shown, rng.choice(roles[:3] * 3 + roles), rng.choice(texts)))
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None here."), rows[3]]
    rows += [(61, None, "user", f"Text {i % 5}.") for i in range(20)]
    rows += [(62, 7, "user", "Same.")] * 200
    rows += [(63, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(700)]
    rows += [(64, 1, "user", "long " * 200_000 + "end.")]
    return [(*row, "x", 5) for row in rows]


def in_sql(rows):
    columns = list(zip(*rows, strict=True))[:4] if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    conversations = pa.table(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
        names=["conv_id", "turn", "role", "text"],
    )
    connection = duckdb.connect()
    connection.register("conversations", conversations)
    return sql_rows(connection, ORACLES["op11_conversation_repair"])


def digest_of(turns):
    text = "\n".join(f"{t['role']}:{t['text']}" for t in turns)
    return hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_equal_sql(spark):
    rows = odd_conversations()
    damaged = conversation_repair.damage(spark.createDataFrame(rows, SCHEMA))
    result = conversation_repair.repair(damaged)
    found = result.collect()
    expected = in_sql(rows)
    assert difference((result.columns, [tuple(r) for r in found]), expected) is None

    turns = {}
    for turn in conversation_repair.repaired(damaged).collect():
        turns.setdefault(turn["conv_id"], []).append(turn)
    for row in found:
        kept = sorted(turns.get(row["conv_id"], []), key=lambda t: t["position"])
        assert [t["position"] for t in kept] == list(range(len(kept)))
        assert digest_of(kept) == row["repaired_sha256"]
        assert "".join(t["edit"] for t in kept) == row["audit"].replace("D", "")


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    damaged = conversation_repair.damage(none)
    assert conversation_repair.repair(damaged).collect() == []
    assert conversation_repair.repaired(damaged).collect() == []


def test_undamaged_rows_need_no_copies_column(spark):
    rows = [(1, 0, "user", "Hello?"), (1, 1, "assistant", "Hi."), (1, 2, "user", "cut")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = conversation_repair.repair(given).first()
    assert (row["audit"], row["cost"], row["truncated"]) == ("KKD", 2, 1)


def test_long_conversations_take_time_in_proportion():
    import time

    def seconds(n):
        path = conversation_repair.Path()
        start = time.perf_counter()
        for i in range(n):
            path.row("usa"[i % 3], i % 7 == 0)
        path.end()
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(40_000) < 20 * max(seconds(10_000), 0.01)
