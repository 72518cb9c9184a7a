"""Conversation repair against a search through all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import Row

from fareweather.llm import conversations
from fareweather.llm.conversations import Node, Repair, damaged, least, op12_conversation_repair, repair, repaired_turns, spelled
from tests.conftest import SMALL

PATTERN = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s|s?(ua)*u?)?")
NAMES = {"u": "user", "a": "assistant"}


def faults(turns: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in turns:
        shown = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns: list[tuple[str, str]], all_ways: bool = False) -> tuple[int, str, list[str]]:
    """Cost, audit and repaired turns: edits tried in order of cost, then of their letters.

    A turn reached again in the same state is not followed further, unless ``all_ways`` are asked for.
    """
    marks = faults(turns)
    queue: list = [(0, "", "", ())]
    reached = set()
    while True:
        cost, audit, roles, lines = heapq.heappop(queue)
        at = sum(letter != "I" for letter in audit)
        if not all_ways and (at, roles[-1:]) in reached:
            continue
        reached.add((at, roles[-1:]))
        if at == len(turns) and PATTERN.fullmatch(roles):
            return cost, audit, list(lines)
        options = []
        if at < len(turns):
            (role, text), fault = turns[at], marks[at]
            options.append((2, "D", "", ()))
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                options.append((more, "K", role[:1], (f"{role}:{text}",)))
                options += [(1 + more, "R", new, (f"{NAMES[new]}:{text}",)) for new in "ua"]
        options += [(5, "I", new, (f"{NAMES[new]}:",)) for new in "ua"]
        for price, letter, initial, line in options:
            if letter == "D" or (initial and PREFIX.fullmatch(roles + initial)):
                heapq.heappush(queue, (cost + price, audit + letter, roles + initial, lines + line))


def by_class(turns: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    lines: list[str] = []
    letters: list[str] = []

    def emit(letter, role, text):
        letters.append(letter)
        if letter != "D":
            lines.append(f"{role}:{text}")

    one = Repair(emit)
    for number, ((role, text), fault) in enumerate(zip(turns, faults(turns))):
        one.turn(number, role, text, fault)
    return one.finish()["cost"], "".join(letters), lines


def some_turns(dice: random.Random, n: int) -> list[tuple[str, str]]:
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "cut", "", " \n", "Why?", "more of it.", "x"]
    return [(dice.choice(roles), dice.choice(texts) + (f" {dice.randrange(9)}." if dice.random() < 0.5 else "")) for _ in range(n)]


def test_all_edits_tried():
    dice = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 9, 30] * 60:
        turns = some_turns(dice, n)
        assert by_class(turns) == cheapest(turns, all_ways=n < 4), turns


@pytest.mark.parametrize("waiting", [1, 3, 7])
def test_settling_early_changes_nothing(monkeypatch, waiting):
    dice = random.Random(waiting)
    for _ in range(60):
        turns = some_turns(dice, 40)
        monkeypatch.setattr(conversations, "WAITING", 10**9)
        whole = by_class(turns)
        monkeypatch.setattr(conversations, "WAITING", waiting)
        assert by_class(turns) == whole


def test_long_conversation_is_settled_on_the_way():
    waiting = []
    one = Repair(lambda *edit: None)
    for i in range(20000):
        one.turn(i, ("user", "assistant", "user")[i % 3], f"{i}.", "" if i % 5 else "b")
        waiting.append(len(one.waiting))
    assert max(waiting) <= 2 * conversations.WAITING and max(node.depth - one.audit.root.depth for _, node in filter(None, one.audit.heads)) < 1000


def test_prefixes_compare_as_texts(monkeypatch):
    dice = random.Random(3)
    for modulus in ((1 << 61) - 1, 3):  # with three hashes nearly all of them collide
        monkeypatch.setattr(conversations, "_MODULUS", modulus)
        nodes = [Node()]
        for _ in range(400):
            nodes.append(Node(dice.choice(nodes[-12:]), dice.choice("DIKR")))
        for _ in range(2000):
            x, y = dice.choice(nodes), dice.choice(nodes)
            assert spelled(least(x, y)) == min(spelled(x), spelled(y))


def expected(rows) -> dict:
    """The whole contract in plain Python."""
    by_conversation: dict = {}
    for row in rows:
        key = f"{' ' if row['conv_id'] is None else row['conv_id']}:{' ' if row['turn'] is None else row['turn']}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if row[name] is None else row[name] for name in ("role", "text"))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by_conversation.setdefault(row["conv_id"], []).extend([(row["turn"], role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = {}
    for conv_id, turns in by_conversation.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        own = [t[1:] for t in turns]
        cost, audit, lines = cheapest(own)
        marks = faults(own)
        numbers = [t[0] for t in turns if t[0] is not None]
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(marks.count(mark) for mark in "bdt"),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def as_dict(df) -> dict:
    rows = df.collect()
    found = {row["conv_id"]: tuple(row)[1:] for row in rows}
    assert len(found) == len(rows)
    return found


def test_query_follows_its_contract(spark):
    assert as_dict(op12_conversation_repair(spark, SMALL)) == expected(spark.read.parquet(f"{SMALL}/conversations.parquet").collect())


ODD = "conv_id long, turn long, role string, text string, CONV_ID string, Text long, gone string, fault int, seen long"


def odd(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", "A."), (1, 5, None, "B."), (1, 5, "user", None)]
    rows += [(2, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(40)] * 2 + [(3, 2**62, "", ""), (3, -(2**62), "s", "long " * 50000)]
    return spark.createDataFrame([(*row, "x", 1, "yes", 2, 3) for row in rows], ODD)


def test_odd_rows(spark):
    table = odd(spark)
    plain = [Row(conv_id=r[0], turn=r[1], role=r[2], text=r[3]) for r in table.collect()]
    assert as_dict(repair(damaged(table), gone="gone")) == expected(plain)


def test_no_rows(spark):
    assert repair(damaged(odd(spark).limit(0)), gone="gone").count() == 0
    assert repaired_turns(odd(spark).limit(0)).count() == 0


def test_repaired_turns_are_what_the_digest_covers(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    turns: dict = {}
    for row in sorted(repaired_turns(damaged(table), gone="gone").collect(), key=lambda r: (r["conv_id"], r["place"])):
        turns.setdefault(row["conv_id"], []).append(row)
    for row in repair(damaged(table), gone="gone").collect():
        own = turns.get(row["conv_id"], [])
        assert "".join(t["edit"] for t in own) == row["audit"]
        text = "\n".join(f"{t['role']}:{t['text']}" for t in own if t["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == row["repaired_sha256"]
        assert PATTERN.fullmatch("".join(t["role"][:1] for t in own if t["edit"] != "D"))
