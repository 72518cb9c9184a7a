"""Conversation structure repair: the cheapest edits that make turns alternate.

A repaired conversation has the roles ``(s?(ua)+)?`` (initials of system, user, assistant). Each
turn is kept (0), given the role that is due (1) or deleted (2); turns without text can be put in
anywhere (5 each). Blank turns and repeats of an earlier turn have to go; a truncated turn that
stays costs 5 more. Of the cheapest edits those whose initials (K, R, D, I) are ASCII-least count.

The audit is a persistent dynamic program over turns and the four states of the pattern. The
edits that lead to a state are a linked node, which shares its whole prefix with other states'
nodes. A node has ancestors at distances 1, 2, 4, ... and a rolling hash of its prefix, so of two
equally cheap prefixes the first difference is found by a logarithmic search; that what lies
before it is really equal is verified letter by letter up to the shared node, and if the hashes
lied, the prefixes are compared in full. Two prefixes of one cost for the same turns never
continue one another, as each more letter costs, so the least prefix stays least.

How it is laid out: faults of single turns are SQL expressions; one shuffle by conversation, then
repeats are numbered and the turns sorted within the partitions, both without a further shuffle.
Conversations then stream through a task one turn after the other. As soon as the prefixes of all
live states meet in one node, what lies before is settled, leaves as repaired turns and is let go
of, so a conversation with a third of all turns takes one task's time, but not its memory (the
digest of a whole text is sequential by its nature).

Defined cases: null ids, turns, roles and texts read as one space where they are written or
hashed; null turns come first; turns of one number are ordered by role, then text; a conversation
of a null id is one like any other; a conversation without turns left has zeros, an empty audit
and the empty digest; an empty or unknown role is never legal and can only get another role or go;
texts count whole; repeated rows are turns that repeat an earlier one; other columns are not read,
whatever their names; a table without rows gives no rows. Gaps beyond a long are the largest long.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareweather.llm.tasks import by_place, small_batches

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Turns that wait for their edits before it is looked whether they are settled.
WAITING = 256

SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"

# The pattern's states: nothing yet, a system turn, a user turn last, an assistant turn last.
_STEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_DUE = ("u", "u", "a", "u")
_NAMES = {"u": "user", "a": "assistant"}
_ENDS = (0, 3)
_MODULUS, _BASE = (1 << 61) - 1, 0x1F0A5B3C7D9E2461


class Node:
    """The last letter of a sequence of edits; ``up[k]`` is the node ``2 ** k`` letters before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None = None, letter: str = ""):
        self.letter, self.depth, self.hash, self.up = letter, 0, 0, []
        if parent is not None:
            self.depth = parent.depth + 1
            self.hash = (parent.hash * _BASE + ord(letter)) % _MODULUS
            up, ancestor = [parent], parent
            while len(up) <= len(ancestor.up):
                ancestor = ancestor.up[len(up) - 1]
                up.append(ancestor)
            self.up = up

    def at(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node


def spelled(node: Node) -> str:
    letters = []
    while node.up:
        letters.append(node.letter)
        node = node.up[0]
    return "".join(reversed(letters))


def same_letters(a: Node, b: Node) -> bool:
    """Whether two nodes of one depth spell the same."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def least(x: Node, y: Node) -> Node:
    """The node whose letters come first in ASCII order; prefixes come before what continues them."""
    if x is y:
        return x
    shorter = x if x.depth <= y.depth else y
    a, b = x.at(shorter.depth), y.at(shorter.depth)
    if a.hash == b.hash:
        if same_letters(a, b):
            return shorter
    else:
        for k in reversed(range(len(a.up))):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        if a.letter != b.letter and same_letters(a.up[0], b.up[0]):
            return x if a.letter < b.letter else y
    return x if spelled(x) <= spelled(y) else y  # two prefixes of one hash that differ


class Audit:
    """The cheapest edits of one conversation, turn by turn; ``settle`` gets each decided letter."""

    def __init__(self, settle: Callable[[str], None]):
        self.settle = settle
        self.root = Node()
        self.heads: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self._insert()

    def turn(self, initial: str, must_go: bool, truncated: bool) -> None:
        """Take in the next turn of the conversation."""
        offers: list[list[tuple[int, Node, str]]] = [[], [], [], []]
        more = TRUNCATED if truncated else 0
        for state, head in enumerate(self.heads):
            if head is None:
                continue
            cost, node = head
            offers[state].append((cost + DELETE, node, "D"))
            if must_go:
                continue
            kept = _STEP[initial][state] if initial in _STEP else None
            if kept is not None:
                offers[kept].append((cost + more, node, "K"))
            if _DUE[state] != initial:
                offers[_STEP[_DUE[state]][state]].append((cost + REROLE + more, node, "R"))
        self.heads = [self._cheapest(choices) for choices in offers]
        self._insert()
        self._prune()

    def _cheapest(self, offers: list[tuple[int, Node, str]]) -> tuple[int, Node] | None:
        if not offers:
            return None
        cost = min(offer[0] for offer in offers)
        return cost, reduce(least, [Node(node, letter) for c, node, letter in offers if c == cost])

    def _insert(self) -> None:
        """Inserted turns; no more than two in a row can be cheapest between two states."""
        for state, before in ((2, (0, 1, 3)), (3, (2,))):
            for source in before:
                self._improve(state, self.heads[source])

    def _improve(self, state: int, source: tuple[int, Node] | None) -> None:
        own = self.heads[state]
        if source is None or (own is not None and own[0] < source[0] + INSERT):
            return
        node, cost = Node(source[1], "I"), source[0] + INSERT
        self.heads[state] = (cost, node if own is None or own[0] > cost else least(own[1], node))

    def _prune(self) -> None:
        """Drop the states whose every continuation is cheaper from the state after an assistant.

        That one continues as the two before the first user turn do, but for a system turn, which
        it can delete.
        """
        last = self.heads[3][0]
        for state, spare in ((0, DELETE), (1, 0)):
            if self.heads[state] is not None and self.heads[state][0] > last + spare:
                self.heads[state] = None

    def settle_shared(self) -> None:
        """Hand out the letters that all live states share."""
        nodes = [head[1] for head in self.heads if head is not None]
        while any(node is not nodes[0] for node in nodes):
            deepest = max(node.depth for node in nodes)
            nodes = [node.up[0] if node.depth == deepest else node for node in nodes]
        shared = nodes[0]
        if shared is self.root:
            return
        for letter in spelled(shared):
            self.settle(letter)
        for head in self.heads:
            node = head[1] if head is not None else shared
            while node is not shared:
                node.up = [ancestor for ancestor in node.up if ancestor.depth >= shared.depth]
                node = node.up[0]
        shared.up = []
        self.root = shared

    def finish(self) -> int:
        """Settle what is left and return the cost."""
        ends = [self.heads[state] for state in _ENDS if self.heads[state] is not None]
        cost = min(end[0] for end in ends)
        for letter in spelled(reduce(least, [node for c, node in ends if c == cost])):
            self.settle(letter)
        return cost


class Repair:
    """One conversation on its way through a task; ``emit`` gets each edit with the turn's new role and text."""

    def __init__(self, emit: Callable[[str, str, str], None]):
        self.emit = emit
        self.audit = Audit(self._settle)
        self.waiting: deque[tuple[str, str]] = deque()
        self.state = 0
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.turns = 0
        self.before: str | None = None
        self.first = self.last = None

    def turn(self, number: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if number is not None and number != self.last:
            self.turns += 1
            self.first = number if self.first is None else self.first
            self.last = number
        if fault in self.faults:
            self.faults[fault] += 1
        self.audit.turn(initial, fault in ("b", "d"), fault == "t")
        self.waiting.append((role, text))
        if len(self.waiting) % WAITING == 0:
            self.audit.settle_shared()

    def _settle(self, letter: str) -> None:
        role, text = ("", "") if letter == "I" else self.waiting.popleft()
        if letter in "RI":
            role = _NAMES[_DUE[self.state]]
        self.emit(letter, role, text)
        if letter != "D":
            self.state = _STEP[role[:1]][self.state]

    def finish(self) -> dict[str, int]:
        cost = self.audit.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            "gaps": min(gaps, 2**63 - 1), "blank": self.faults["b"], "duplicate": self.faults["d"],
            "truncated": self.faults["t"], "illegal": self.illegal, "cost": cost,
        }


def ordered_turns(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """The turns with their ``fault``, each conversation in order within one partition.

    ``fault`` is b(lank), d(uplicate), t(runcated) or empty; g(one) marks a row that only makes its
    conversation known: those where the column that ``gone`` names is true.
    """
    names = ["conv_id", "turn", "role", "text"]
    rows = by_place(turns, *names, *([gone] if gone else [])).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(gone, F.lit(False)) if gone else F.lit(False)).alias("gone"),
    )
    numbered = rows.repartition("conv_id").withColumn(
        "seen",
        F.row_number().over(
            Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
        ),
    )
    stripped = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(F.col("gone"), "g")
        .when(stripped == "", "b")
        .when(F.col("seen") > 1, "d")
        .when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), "t")
        .otherwise("")
    )
    return (
        numbered.sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "seen"
        )
        .select("conv_id", "turn", "role", "text", fault.alias("fault"))
    )


def _conversations(batches: Iterator[pa.RecordBatch], start: Callable, ended: Callable) -> Iterator[None]:
    """Run the rows through one ``Repair`` after the other; yields after each batch."""
    missing = object()
    current, repair = missing, None
    for batch in batches:
        for conv_id, number, role, text, fault in zip(*(batch[name].to_pylist() for name in ("conv_id", "turn", "role", "text", "fault"))):
            if conv_id != current:
                if repair is not None:
                    ended(current, repair)
                current, repair = conv_id, start(conv_id)
            if fault != "g":
                repair.turn(number, role, text, fault)
        yield
    if repair is not None:
        ended(current, repair)
        yield


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """One row for each conversation: its faults, the cost, the audit and the digest of its repaired form."""
    small_batches(turns.sparkSession)
    names = [part.split()[0] for part in SUMMARY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        audit: list[str] = []
        digest = [hashlib.sha256(), b""]

        def emit(letter: str, role: str, text: str) -> None:
            audit.append(letter)
            if letter != "D":
                digest[0].update(digest[1] + f"{role}:{text}".encode())
                digest[1] = b"\n"

        def start(conv_id: int | None) -> Repair:
            audit.clear()
            digest[:] = hashlib.sha256(), b""
            return Repair(emit)

        def ended(conv_id: int | None, repaired: Repair) -> None:
            figures = repaired.finish()
            done.append({"conv_id": conv_id, **figures, "audit": "".join(audit), "repaired_sha256": digest[0].hexdigest()})

        for _ in _conversations(batches, start, ended):
            columns = [pa.array([row[name] for row in done], pa.string() if name in ("audit", "repaired_sha256") else pa.int64()) for name in names]
            done.clear()
            yield pa.RecordBatch.from_arrays(columns, names)

    return ordered_turns(turns, gone).mapInArrow(run, SUMMARY)


def repaired_turns(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """Every turn with its edit, in order by ``place``; deleted ones (D) keep their old role and text."""
    small_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        here = [None, 0]

        def emit(letter: str, role: str, text: str) -> None:
            out.append((*here, letter, role, text))
            here[1] += 1

        def start(conv_id: int | None) -> Repair:
            here[:] = conv_id, 0
            return Repair(emit)

        for _ in _conversations(batches, start, lambda conv_id, repaired: repaired.finish()):
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            out.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)], ["conv_id", "place", "edit", "role", "text"]
            )

    return ordered_turns(turns, gone).mapInArrow(run, TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with known damage, by a hash of conversation and turn; dropped ones are marked ``gone``."""
    rows = by_place(conversations, "conv_id", "turn", "role", "text")

    def written(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn"))) % 20
    text = (
        F.when(kind == 1, "").when(kind == 2, F.translate(written("text"), ".!?", "")).otherwise(written("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(written("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), gone="gone")
