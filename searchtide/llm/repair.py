"""Repair of conversation structure by a generalised LR parser with weighted edits.

A conversation is read as the initials of its roles. It should be derived by the grammar

    C -> (nothing) | P | s P        P -> P T | T        T -> u a

that is, an optional system turn and then pairs of a user's and an assistant's turn, or nothing. The parser's tables are LR(0) item
sets made from these rules. Its stacks form a graph: a node is an LR state on top of another node, and equal stacks are one node, so all stacks
share what they have in common. At each row a stack may shift the row as it is (keep), shift it as a user's or an
assistant's turn (rerole), or pass it over (delete); between rows it may shift a turn that is not there (insert). Where edits
lead to equal tops, these are merged by the minimum of (cost, audit), the audit being the initials of the edits in order. So all ways to repair a
conversation are followed at once, by a handful of tops: the rules recurse on the left, and no stack is deeper than four states.
(Of two equally dear audits of one top neither begins with the other, since the rest would be insertions, which cost more. So the
lesser one stays the lesser one whatever follows.)

Two passes go over the rows of each conversation, in order, as a stream: the first sees only an initial, flags and a digest of each row
and returns the audit; the second applies the audit to the texts. Memory holds a byte of audit and a digest per turn, never the texts. A
conversation is repaired in sequence, in one task; one with very many rows delays that task and breaks nothing.

Defined results: a null text is empty, and so blank. A null role has an empty initial. A row whose initial is not s, u or a cannot be kept,
only reroled or deleted. Turns are in order of ``turn``, nulls first; rows of the same turn in order of role (null first), then of a hash
of role and text. A null id is a conversation of its own. An empty table gives an empty result. Only the columns named are looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
#: initials of the turns that may be made up and of the roles that may be given
MADE = "au"
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "PT"), ("P", "T"), ("T", "ua"))
_GOAL = RULES[0][0]
_BLANKS = " \t\n\x0b\x0c\r"

Weight = tuple[int, str]


# --- tables -------------------------------------------------------------------------------------


def item_sets(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[list[dict[str, int]], list[list[tuple[str, int]]]]:
    """Moves ``state -> symbol -> state``, and for each state the rules (left side, length) that end in it."""
    heads = {left for left, _ in rules}

    def closed(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            right = rules[rule][1]
            if dot < len(right) and right[dot] in heads:
                new = {(k, 0) for k, (left, _) in enumerate(rules) if left == right[dot]} - items
                items |= new
                todo += new
        return frozenset(items)

    states = [closed({(k, 0) for k, (left, _) in enumerate(rules) if left == rules[0][0]})]
    moves: list[dict[str, int]] = []
    for state in states:
        after: dict[str, set] = {}
        for rule, dot in sorted(state):
            if dot < len(rules[rule][1]):
                after.setdefault(rules[rule][1][dot], set()).add((rule, dot + 1))
        moves.append({})
        for symbol, items in after.items():
            target = closed(items)
            if target not in states:
                states.append(target)
            moves[-1][symbol] = states.index(target)
    ends = [[(rules[r][0], len(rules[r][1])) for r, dot in sorted(s) if dot == len(rules[r][1])] for s in states]
    return moves, ends


MOVES, ENDS = item_sets()


class Node:
    """An LR state on top of another node. What a node leads to is worked out once."""

    __slots__ = ("below", "state", "above", "accepts", "alive")

    def __init__(self, state: int, below: Node | None = None) -> None:
        self.state, self.below = state, below
        self.above: dict[str, Node] = {}
        self.accepts = any(left == _GOAL for left, _ in ENDS[state])
        #: a top without moves that accepts nothing is of use only to its reductions
        self.alive = self.accepts or any(s.islower() for s in MOVES[state])

    def shifted(self, symbol: str) -> Node | None:
        if symbol not in MOVES[self.state]:
            return None
        if symbol not in self.above:
            self.above[symbol] = Node(MOVES[self.state][symbol], self)
        return self.above[symbol]

    def reduced(self) -> list[Node]:
        """The stacks after each rule that ends here, but for those that end the conversation."""
        out = []
        for left, length in ENDS[self.state]:
            if left != _GOAL:
                bottom = self
                for _ in range(length):
                    bottom = bottom.below
                out.append(bottom.shifted(left))
        return out


class Parser:
    """All cheapest repairs of the rows so far: the stack tops with their (cost, audit)."""

    #: rows after which what all audits begin with is put away
    SETTLE_ROWS = 256

    def __init__(self) -> None:
        self.tops: dict[Node, Weight] = {}
        self.settled: list[str] = []
        self.rows = 0
        self._add(self.tops, Node(0), (0, ""))

    @staticmethod
    def _add(tops: dict[Node, Weight], node: Node, weight: Weight) -> None:
        """Merge a stack with its equal; follow reductions and insertions from it as long as they are cheaper than what is there."""
        todo = [(node, weight)]
        while todo:
            node, weight = todo.pop()
            if node.alive:
                if node in tops and tops[node] <= weight:
                    continue
                tops[node] = weight
                cost, audit = weight
                todo += [(made, (cost + INSERT, audit + "I")) for made in map(node.shifted, MADE) if made is not None]
            todo += [(lower, weight) for lower in node.reduced()]

    def read(self, initial: str, fault: str) -> None:
        """One row. Faults: ``b`` (blank) and ``d`` (duplicate) must be deleted, ``t`` (truncated) costs more unless deleted."""
        after: dict[Node, Weight] = {}
        extra = TRUNCATED if fault == "t" else 0
        for node, (cost, audit) in self.tops.items():
            self._add(after, node, (cost + DELETE, audit + "D"))
            if fault in ("b", "d"):
                continue
            kept = node.shifted(initial) if initial.islower() else None
            if kept is not None:
                self._add(after, kept, (cost + KEEP + extra, audit + "K"))
            for symbol in MADE:
                reroled = node.shifted(symbol)
                if reroled is not None:
                    self._add(after, reroled, (cost + REROLE + extra, audit + "R"))
        self.tops = after
        self.rows += 1
        if self.rows % self.SETTLE_ROWS == 0:
            common = os.path.commonprefix([audit for _, audit in after.values()])
            self.settled.append(common)
            self.tops = {node: (cost, audit[len(common) :]) for node, (cost, audit) in after.items()}

    def best(self) -> Weight:
        cost, audit = min(weight for node, weight in self.tops.items() if node.accepts)
        return cost, "".join(self.settled) + audit


def cheapest(turns: Iterable[tuple[str, str]]) -> Weight:
    """Cost and audit of the cheapest repair of rows (initial, fault)."""
    parser = Parser()
    for initial, fault in turns:
        parser.read(initial, fault)
    return parser.best()


class Applied:
    """A conversation as its audit makes it, row by row: ``role:text`` lines, hashed."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last, self.lines, self.digest = audit, 0, "", 0, hashlib.sha256()

    def _emit(self, role: str | None, text: str) -> None:
        wanted = "a" if self.last == "u" else "u"
        self.last = wanted if role is None else role[:1]
        self.digest.update(("\n" if self.lines else "").encode() + f"{NAMES[wanted] if role is None else role}:{text}".encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._emit(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._emit(role if edit == "K" else None, text)

    def finished(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


# --- Spark --------------------------------------------------------------------------------------


def _in_order(rows: DataFrame) -> DataFrame:
    """Conversations whole in their partitions; in each the row marked as first, then the turns."""
    order = (F.col("first").desc(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("digest"))
    return rows.repartition("conv").sortWithinPartitions("conv", *order).drop("first")


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column) -> DataFrame:
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    # the length of the role keeps role and text apart
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                        text.alias("text"), digest.alias("digest"), present.alias("present"), F.lit(False).alias("first"))


_AUDITED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None) -> DataFrame:
    """One row per conversation: ``conv``, its faults, and ``cost`` and ``audit`` of its cheapest repair.

    Rows for which ``present`` is not true are no turns; they only name a conversation.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else F.coalesce(present, F.lit(False)))
    ended = F.rtrim("text", F.lit(_BLANKS))
    fault = F.when(ended == "", "b").when(~F.substring(ended, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    narrow = rows.select("conv", "turn", "role", "digest", "present", "first", F.coalesce(F.substring("role", 1, 1), F.lit("")).alias("initial"), fault.alias("fault"))
    kind = turns.schema[conv_col].dataType.simpleString()
    names = ["conv", *(c.split()[0] for c in _AUDITED.split(", "))]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, work = None, None
        for batch in batches:
            types, done = [batch.schema.field("conv").type, *[pa.int64()] * 6, pa.string()], []
            values = (batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault", "digest", "present"))
            for key, turn, initial, fault, digest, here in zip(*values):
                if work is None or key != conv:
                    if work is not None:
                        done.append((conv, *work.summary()))
                    conv, work = key, _Audited()
                if here:
                    work.row(turn, initial, fault, digest)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
        if work is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((conv, *work.summary()), types)], names)

    return _in_order(narrow).mapInArrow(parsed, f"conv {kind}, {_AUDITED}")


class _Audited:
    """Faults and repairs of a conversation, row by row."""

    def __init__(self) -> None:
        self.parser, self.seen, self.last = Parser(), set(), None
        self.lowest, self.highest, self.turns, self.illegal = None, None, 0, 0
        self.faults = {"b": 0, "d": 0, "t": 0}

    def row(self, turn: int | None, initial: str, fault: str, digest: bytes) -> None:
        if turn is not None and turn != self.highest:
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
            self.turns += 1
        if fault != "b" and digest in self.seen:
            fault = "d"
        self.seen.add(digest)
        if fault:
            self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.parser.read(initial, fault)

    def summary(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        return gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, *self.parser.best()


def applied(turns: DataFrame, audited: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", present: Column | None = None) -> DataFrame:
    """``conv`` and ``repaired_sha256`` of each conversation, its audit applied to its rows.

    The audit of a conversation travels as a row before its turns, so that neither side is held.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col, F.lit(True) if present is None else F.coalesce(present, F.lit(False)))
    heads = audited.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"),
                           F.lit(None).cast("binary").alias("digest"), F.lit(True).alias("present"), F.lit(True).alias("first"))
    kind = turns.schema[conv_col].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            done = []
            for conv, role, text, digest in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text", "digest"))):
                if digest is None:
                    if work is not None:
                        done.append((key, work.finished()))
                    key, work = conv, Applied(text)
                else:
                    work.row(role or "", text)
            kind_of = batch.schema.field("conv").type
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kind_of), pa.array([d for _, d in done])], ["conv", "repaired_sha256"])
        if work is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind_of), pa.array([work.finished()])], ["conv", "repaired_sha256"])

    both = rows.where("present").unionByName(heads)
    return _in_order(both).select("conv", "role", "text", "digest").mapInArrow(hashed, f"conv {kind}, repaired_sha256 string")
