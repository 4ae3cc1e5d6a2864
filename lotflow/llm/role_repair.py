"""Repair of the turn structure of conversations: a generalised LR parse of the roles with weighted edits.

Roles follow a small grammar: an optional system turn, then one or more pairs of user and assistant, or nothing at all.
A conversation is parsed by the LR(0) tables of that grammar over a graph-structured stack. At each turn all stacks go on at
once: the turn is kept (K), gets another role (R) or is deleted (D), and before it turns may be inserted (I), each at its
cost. Stacks with equal tops are merged, and each way into a top keeps its least (cost, audit), where the audit is the
letters of the edits so far; the accepted stack with the least (cost, audit) is the repair. Turns that are blank or repeat
an earlier turn must be deleted; turns that are kept though their text breaks off cost extra.

Turns are read in order, one conversation at a time, in chunks of ``CHUNK`` turns: what a chunk leaves is a handful of stacks, each
with its cost, audit and running digest, so memory grows with the audit alone, a letter a turn. The digest of a
conversation is one sequential hash, so its turns meet in one task, sorted by Spark and streamed.

Null roles and texts count as one space. Turns ascend by number, nulls first; equal numbers by role, then text; repeated rows
are turns of their own, each but the first a duplicate. Rows with a null conversation id are one conversation. Other columns are left aside. Roles
count by their first letter; one that is none of s, u, a can only be replaced or deleted. A conversation all of whose rows are
marked as gone (column ``gone``) keeps its row, with zeros and empty texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotflow.llm.texts import sized
from lotflow.shipping import ship

#: Grammar of the roles' first letters; the first rule ends the parse.
RULES = (("S", "C"), ("C", ""), ("C", "T"), ("T", "sP"), ("T", "P"), ("P", "Pua"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, BROKEN = 2, 3, 2, 1
CHUNK = 512
_SPACE = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")

Weight = tuple[int, str]


class Tables:
    """LR(0) automaton of a grammar: moves by symbol, the rules that end in a state, and the state in which a parse is accepted."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES):
        self.rules, goal = rules, rules[0][0]
        heads = {head for head, _ in rules}

        def closed(items: frozenset) -> frozenset:
            items = set(items)
            while True:
                wanted = {rules[rule][1][dot] for rule, dot in items if dot < len(rules[rule][1])} & heads
                grown = items | {(n, 0) for n, (head, _) in enumerate(rules) if head in wanted}
                if grown == items:
                    return frozenset(items)
                items = grown

        states = [closed(frozenset((n, 0) for n, (head, _) in enumerate(rules) if head == goal))]
        self.move: list[dict[str, int]] = []
        for items in states:  # grows as new states are found
            moves = {}
            for symbol in sorted({rules[rule][1][dot] for rule, dot in items if dot < len(rules[rule][1])}):
                target = closed(frozenset((rule, dot + 1) for rule, dot in items if rules[rule][1][dot : dot + 1] == symbol))
                if target not in states:
                    states.append(target)
                moves[symbol] = states.index(target)
            self.move.append(moves)
        ended = [[rule for rule, dot in sorted(items) if dot == len(rules[rule][1])] for items in states]
        # a reduction to a symbol after which nothing can follow only matters at the end of the input
        inner = {body[k] for _, body in rules for k in range(len(body) - 1)}
        self.reduce = [[rule for rule in ending if rules[rule][0] in inner] for ending in ended]
        self.finish = [[rule for rule in ending if rules[rule][0] not in inner] for ending in ended]
        self.accept = self.move[0][rules[0][1]]


@dataclass(frozen=True)
class Node:
    """A symbol on the stack, as the state after it, and what lies below; equal nodes are one."""

    state: int
    below: Node | None = None

    def states(self) -> tuple[int, ...]:
        return (*(self.below.states() if self.below else ()), self.state)


class Stacks:
    """The graph-structured stack at one place of the input: for each top state the nodes below it, with the weight of all edits so far."""

    def __init__(self, tables: Tables):
        self.tables, self.tops = tables, {}

    def way(self, state: int, below: Node | None, weight: Weight) -> bool:
        """Merge a way into the top with this state; of equal ways the lighter one stays."""
        ways = self.tops.setdefault(state, {})
        if below in ways and ways[below] <= weight:
            return False
        ways[below] = weight
        return True

    def ways(self) -> list[tuple[int, Node | None, Weight]]:
        return [(state, below, weight) for state, ways in self.tops.items() for below, weight in ways.items()]

    def reduced(self, finish: bool = False) -> None:
        """All reductions, until they bring nothing new."""
        changed = True
        while changed:
            changed = False
            for state, below, weight in self.ways():
                for rule in self.tables.reduce[state] + (self.tables.finish[state] if finish else []):
                    head, body = self.tables.rules[rule]
                    node = Node(state, below)
                    for _ in body:
                        node = node.below
                    target = self.tables.move[node.state].get(head)
                    if target is not None:
                        changed |= self.way(target, node, weight)

    def filled(self) -> None:
        """Insertions and reductions, until they bring nothing new."""
        new = True
        while new:
            self.reduced()
            new = False
            for state, below, (cost, audit) in self.ways():
                for symbol in ROLES:
                    target = self.tables.move[state].get(symbol)
                    if target is not None:
                        new |= self.way(target, Node(state, below), (cost + INSERT, audit + "I"))

    def read(self, letter: str, must_go: bool, broken: bool) -> Stacks:
        """The stacks after one turn; insertions before it are made first."""
        self.filled()
        after = Stacks(self.tables)
        for state, below, (cost, audit) in self.ways():
            after.way(state, below, (cost + DELETE, audit + "D"))
            for symbol, target in self.tables.move[state].items() if not must_go else ():
                if symbol == letter:
                    after.way(target, Node(state, below), (cost + BROKEN * broken, audit + "K"))
                elif symbol in ROLES:
                    after.way(target, Node(state, below), (cost + REROLE + BROKEN * broken, audit + "R"))
        after.reduced()
        return after

    def accepted(self) -> Weight:
        self.filled()
        self.reduced(finish=True)
        return min(self.tops[self.tables.accept].values())


_TABLES = Tables()
Stack = tuple[tuple[int, ...], int]


@lru_cache(1 << 15)
def advance(stacks: tuple[Stack, ...], turns: str, last: bool) -> tuple[tuple[tuple[int, ...], int, int, str], ...]:
    """Stacks after some turns, lightest audit first: states, cost, number of the stack it came from, edits.

    ``stacks`` are states and costs, lightest audit first. A turn is its role's letter, in upper case if its text breaks
    off, or ``-`` if it must go. After the last turns only the accepted stack comes out.
    """
    now = Stacks(_TABLES)
    for number, (states, cost) in enumerate(stacks):
        below = None
        for state in states[:-1]:
            below = Node(state, below)
        now.way(states[-1], below, (cost, chr(number)))
    for turn in turns:
        now = now.read(turn.lower(), turn == "-", turn.isupper())
    ends = [((), now.accepted())] if last else [(Node(state, below).states(), weight) for state, below, weight in now.ways()]
    found = sorted((audit, cost, states) for states, (cost, audit) in ends)
    return tuple((states, cost, ord(audit[0]), audit[1:]) for audit, cost, states in found)


@dataclass
class Path:
    """A stack with what its edits have come to so far."""

    states: tuple[int, ...]
    cost: int = 0
    audit: tuple = ()
    digest: object = None
    system: bool = False
    last: str = ""

    def edited(self, edits: str, turns: list[tuple[str, str, str]]) -> Path:
        """The path after some more edits; its digest takes the turns that stay."""
        digest, system, last, rows = self.digest.copy(), self.system, self.last, iter(turns)
        for edit in edits:
            role, text, _ = next(rows) if edit != "I" else ("", "", "")
            if edit == "D":
                continue
            role = role if edit == "K" else ROLES["a" if last == "u" else "u"]
            digest.update(f"{chr(10) if last else ''}{role}:{text}".encode())
            last, system = role[0], system or role[0] == "s"
        return replace(self, audit=(self.audit, edits), digest=digest, system=system, last=last)


class Conversation:
    """Counts of one conversation, turn by turn, and its parse, chunk by chunk."""

    def __init__(self, conv_id):
        self.conv_id, self.paths, self.held = conv_id, [Path((0,), digest=hashlib.sha256())], []
        self.blank = self.duplicate = self.broken = self.illegal = self.distinct = 0
        self.first = self.turn = self.letter = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        bare = text.rstrip(_SPACE)
        blank, duplicate = not bare, bool(bare) and again
        broken = bool(bare) and not again and not bare.endswith(_ENDS)
        self.blank, self.duplicate, self.broken = self.blank + blank, self.duplicate + duplicate, self.broken + broken
        letter = role[:1]
        self.illegal += self.letter is not None and self.letter + letter not in LEGAL
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.turn
            self.turn = turn
        self.letter = letter
        known = letter if letter in ("s", "u", "a") else "x"
        self.held.append((role, text, "-" if blank or duplicate else known.upper() if broken else known))
        if len(self.held) >= CHUNK:
            self._parse(False)

    def _parse(self, last: bool) -> None:
        least = min(path.cost for path in self.paths)
        ways = advance(tuple((path.states, path.cost - least) for path in self.paths), "".join(turn[2] for turn in self.held), last)
        self.paths = [replace(self.paths[start].edited(edits, self.held), states=states, cost=least + cost) for states, cost, start, edits in ways]
        self.held = []

    def row(self) -> tuple:
        self._parse(True)
        [path] = self.paths
        parts, audit = [], path.audit
        while audit:
            audit, edits = audit
            parts.append(edits)
        gaps = self.turn - self.first + 1 - self.distinct if self.distinct else 0
        counts = (gaps, self.blank, self.duplicate, self.broken, self.illegal, path.cost)
        return (self.conv_id, *counts, "".join(reversed(parts)), path.digest.hexdigest(), path.system)


def _in_order(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone, again), whole conversations in order; ``again``: role and text came before."""
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    role, text = (F.when(gone, "").otherwise(F.coalesce(F.col(name), F.lit(" "))) for name in (role_col, text_col))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone"))
    # one shuffle serves both sorts: equal turns for the window, and the order of the conversation
    equal = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    rows = rows.repartition("conv_id").withColumn("again", F.row_number().over(equal) > 1)
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: its id, gaps, counts of faults, cost, audit, repaired_sha256, system (whether a system turn is kept)."""
    rows = _in_order(turns, conv_col, turn_col, role_col, text_col)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def found() -> Iterator[tuple]:
            nonlocal schema
            current = None
            for batch in batches:
                schema = schema or pa.schema(
                    [("conv_id", batch.column(0).type), *((name, pa.int64()) for name in _COUNTS)]
                    + [("audit", pa.string()), ("repaired_sha256", pa.string()), ("system", pa.bool_())]
                )
                for conv_id, turn, role, text, gone, again in zip(*(column.to_pylist() for column in batch.columns)):
                    if current is None or conv_id != current.conv_id:
                        if current is not None:
                            yield current.row()
                        current = Conversation(conv_id)
                    if not gone:
                        current.add(turn, role, text, again)
            if current is not None:
                yield current.row()

        held: list[tuple] = []
        for row in found():
            held.append(row)
            if len(held) >= 1000:
                yield from sized(iter(held), schema)
                held = []
        if held:
            yield from sized(iter(held), schema)

    ship(turns.sparkSession)
    out = rows.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{name} long' for name in _COUNTS)}, audit string, repaired_sha256 string, system boolean")
    return out.withColumnRenamed("conv_id", conv_col)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns after repair: conversation id, place (from 0), edit, role, text; deleted turns are left out."""
    names = (conv_col, turn_col, role_col, text_col)
    kept = turns.where("NOT gone") if "gone" in turns.columns else turns
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = _in_order(kept, *names).select("conv_id", "role", "text", F.row_number().over(order).alias("nth"))
    found = repairs(kept, *names).select(F.col(conv_col).alias("conv_id"), "audit", "system")
    kind = found.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [pa.field("conv_id", batch.column(0).type), *(pa.field(n, t) for n, t in (("place", pa.int64()), ("edit", pa.string()), ("at", pa.int64()), ("role", pa.string())))]
            schema = pa.schema(fields)

            def edits() -> Iterator[tuple]:
                for conv_id, audit, system in zip(*(column.to_pylist() for column in batch.columns)):  # noqa: B023
                    place = at = 0
                    for edit in audit:
                        at += edit != "I"
                        if edit != "D":
                            yield conv_id, place, edit, None if edit == "I" else at, ROLES["ua"[(place - system) % 2]]
                            place += 1

            yield from sized(edits(), schema)

    steps = found.mapInArrow(run, f"conv_id {kind}, place long, edit string, at long, role string").withColumnRenamed("role", "new_role")
    rows = rows.withColumnRenamed("conv_id", "own")
    joined = steps.join(rows, steps["conv_id"].eqNullSafe(rows["own"]) & (steps["at"] == rows["nth"]), "left")
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("new_role"))
    return joined.select(F.col("conv_id").alias(conv_col), "place", "edit", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of conversation and turn: rows gone, emptied, broken off, repeated, or of role user."""
    key = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    text, role = (F.coalesce(F.col(name), F.lit(" ")) for name in ("text", "role"))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(role)
    copies = F.explode(F.array_repeat((fault == 0), F.when(fault == 3, 2).otherwise(1))).alias("gone")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)
