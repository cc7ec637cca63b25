"""Conversation structure repair: a generalised LR parser over the role grammar, with weighted edits.

A conversation's roles, by their initials, must be a word of the grammar below: an optional system turn, then user and assistant
turns in pairs. Where they are not, rows are deleted or given another role, and empty turns inserted, at the least total cost; of
equal costs the edits are taken whose initials come first (D, I, K, R).

The parser keeps every parse that may still be the cheapest in one graph-structured stack: nodes are LR states that share the
nodes below them, and a row is shifted from all tops at once, as it is, under another role, or not at all, after any
insertions. Equal tops are one, which keeps the least (cost, edits); tops that cost too much to be made up for are left. The tables
are derived from the grammar, which lets stacks grow to three nodes only. With costs relative to the least there are few different
graphs, so what a kind of row does to a graph is worked out once and looked up for all other rows.

Every top carries the digest of its repaired text so far and, in a byte per row, where it came from. Neither texts nor
decisions are held back: a conversation is read once, in order, row by row, and takes a few bytes of memory per row whatever its texts
hold. It is one task's, since one digest over all its turns is asked for; that task streams from a sort that spills.

Defined cases: null ids, turns, roles and texts read as one space when a row is damaged and printed; the null id is a conversation of its
own, null turns come first. Rows of the same turn are ordered by role, then text. Conversations whose rows are all dropped are
returned with zeros. An empty table gives an empty result, and no column but the four is read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The grammar of role initials, s?(ua)+ or nothing: S is the start, H a head, P an open pair, B closed pairs.
RULES = (("S", ()), ("S", ("B",)), ("B", ("P", "a")), ("P", ("H", "u")), ("P", ("B", "u")), ("H", ()), ("H", ("s",)))
START, END = "S", "$"
#: What edits cost; TRUNCATED is added to a row that stays truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Roles that a row may be given, and that an inserted turn may have.
GIVEN = {"u": "user", "a": "assistant"}
#: Initials the grammar knows, and those that may follow one another.
TERMINALS, PAIRS = ("s", "u", "a"), ("su", "ua", "au")
_SPACES = " \t\n\x0b\x0c\r"

Item = tuple[int, int]


class Table:
    """SLR(1) tables of a small grammar: ``shift[state][terminal]``, ``reduce[state][terminal]`` (rules), ``goto[state][symbol]``."""

    def __init__(self, rules: tuple = RULES, start: str = START):
        self.rules = rules
        symbols = {x for left, right in rules for x in (left, *right)}
        inner = {left for left, _ in rules}
        empty = {left for left, right in rules if not right}
        first = {x: set() if x in inner else {x} for x in symbols}
        follow = {x: {END} if x == start else set() for x in inner}
        for _ in range(len(rules) * len(symbols)):  # to the fixed point
            for left, right in rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for i, x in enumerate(right):
                    if all(y in empty for y in right[:i]):
                        first[left] |= first[x]
                    if x in inner:
                        rest = right[i + 1 :]
                        for j, y in enumerate(rest):
                            if all(z in empty for z in rest[:j]):
                                follow[x] |= first[y]
                        if all(y in empty for y in rest):
                            follow[x] |= follow[left]
        begin = self._closure({(i, 0) for i, (left, _) in enumerate(rules) if left == start})
        self.states, self.goto = [begin], []
        for state in self.states:  # grows
            moves = {}
            for x in sorted(symbols):
                beyond = self._closure({(r, dot + 1) for r, dot in state if rules[r][1][dot : dot + 1] == (x,)})
                if beyond:
                    if beyond not in self.states:
                        self.states.append(beyond)
                    moves[x] = self.states.index(beyond)
            self.goto.append(moves)
        done = [[r for r, dot in state if dot == len(rules[r][1])] for state in self.states]
        self.reduce = [{x: [r for r in rs if x in follow[rules[r][0]]] for x in {END} | symbols - inner} for rs in done]
        self.accepts = [any(rules[r][0] == start for r in rs) for rs in done]
        # States in which there is nothing to do but one reduction, whatever comes next.
        self.default = [rs[0] if len(state) == 1 and rs and rules[rs[0]][0] != start else None for state, rs in zip(self.states, done)]

    def _closure(self, items: set[Item]) -> frozenset[Item]:
        items = set(items)
        while True:
            wanted = {self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}
            more = {(i, 0) for i, (left, _) in enumerate(self.rules) if left in wanted} - items
            if not more:
                return frozenset(items)
            items |= more


#: A stack from its top down: (state, the stack below), shared between parses.
Stack = tuple[int, "Stack | None"]
BOTTOM: Stack = (0, None)
TABLE = Table()
def reduced(stack: Stack, rule: int) -> Stack:
    left, right = TABLE.rules[rule]
    for _ in right:
        stack = stack[1]
    return TABLE.goto[stack[0]][left], stack


def shifted(stack: Stack, terminal: str) -> set[Stack]:
    """All stacks after the reductions that ``terminal`` calls for, its shift, and what must be reduced then; for END those that accept."""
    out, todo, seen = set(), [stack], {stack}
    while todo:
        top = todo.pop()
        if terminal == END:
            if TABLE.accepts[top[0]]:
                out.add(top)
        elif terminal in TABLE.goto[top[0]]:
            after = (TABLE.goto[top[0]][terminal], top)
            while (rule := TABLE.default[after[0]]) is not None:
                after = reduced(after, rule)
            out.add(after)
        for rule in TABLE.reduce[top[0]][terminal]:
            if TABLE.rules[rule][0] != START and (after := reduced(top, rule)) not in seen:
                seen.add(after)
                todo.append(after)
    return out


#: Pairs closed: what a parse that has read nothing but a system turn can go on with, this one can as well, but for a system turn.
CLOSED: Stack = (TABLE.goto[0]["B"], BOTTOM)
HEADED: Stack = (TABLE.goto[0]["H"], BOTTOM)


@dataclass(frozen=True)
class Top:
    """A top of the graph: its stack, its cost above the least, and its place in the order of the edits so far.

    All tops have read the same rows and end with the edit of the last, so no one's edits begin another's and places are enough.
    """

    stack: Stack
    cost: int
    rank: int


FIRST = (Top(BOTTOM, 0, 0),)


@dataclass(frozen=True)
class Move:
    """How a top comes about: from which top before, by which edits, and the roles written ("=": the row's own)."""

    origin: int
    edits: str
    roles: tuple[str, ...]


def _inserted(tops: tuple[Top, ...]) -> dict[Stack, tuple]:
    """The cheapest way to each stack by insertions alone: cost, rank, edits, roles, origin."""
    best = {t.stack: (t.cost, t.rank, "", (), i) for i, t in enumerate(tops)}
    todo = list(best)
    while todo:
        stack = todo.pop()
        cost, rank, edits, roles, i = best[stack]
        for initial, role in GIVEN.items():
            for after in shifted(stack, initial):
                way = (cost + INSERT, rank, edits + "I", (*roles, role), i)
                if after not in best or way < best[after]:
                    best[after] = way
                    todo.append(after)
    return best


@cache
def _bridge(stack: Stack, other: Stack) -> int | None:
    """What it costs a parse at ``stack``, at most, to do whatever one at ``other`` can do; None if that isn't known."""
    reach = {s: way[0] for s, way in _inserted((Top(stack, 0, 0),)).items()}
    ways = [reach[other]] if other in reach else []
    if other in (BOTTOM, HEADED) and CLOSED in reach:
        ways.append(reach[CLOSED] + (DELETE if other == BOTTOM else 0))
    return min(ways, default=None)


def _hopeless(stack: Stack, found: dict[Stack, tuple]) -> bool:
    """Whether another top can do for less whatever this one can: then it isn't on the best way."""
    bridges = ((way[0], _bridge(other, stack)) for other, way in found.items() if other != stack)
    return any(bridge is not None and cost + bridge < found[stack][0] for cost, bridge in bridges)


@cache
def step(tops: tuple[Top, ...], initial: str, must_go: bool, truncated: bool) -> tuple[tuple[Top, ...], tuple[Move, ...], int]:
    """One row read from all tops at once: the tops after it, their moves, and what the least cost rises by."""
    found: dict[Stack, tuple] = {}
    stay = TRUNCATED if truncated else 0
    for stack, (cost, rank, edits, roles, i) in _inserted(tops).items():
        offers = [(stack, DELETE, "D", ())]
        if not must_go:
            if initial in TERMINALS:
                offers += [(after, stay, "K", ("=",)) for after in shifted(stack, initial)]
            offers += [(after, REROLE + stay, "R", (f"={role}",)) for x, role in GIVEN.items() for after in shifted(stack, x)]
        for after, more, edit, written in offers:
            way = (cost + more, rank, edits + edit, roles + written, i)
            if after not in found or way < found[after]:
                found[after] = way
    least = min(way[0] for way in found.values())
    kept = sorted((s for s in found if not _hopeless(s, found)), key=lambda s: found[s][1:3])
    after = tuple(Top(s, found[s][0] - least, n) for n, s in enumerate(kept))
    return after, tuple(Move(found[s][4], found[s][2], found[s][3]) for s in kept), least


@cache
def finish(tops: tuple[Top, ...]) -> tuple[Move, int]:
    """The cheapest accepted end, and its cost above the least."""
    cost, _, edits, roles, i = min(way for stack, way in _inserted(tops).items() if shifted(stack, END))
    return Move(i, edits, roles), cost


class Repair:
    """The repair of one conversation, row by row."""

    def __init__(self):
        self.tops, self.cost = FIRST, 0
        self.digests: list = [None]  # of each top's text so far; None while it is empty
        self.trail = array("I")  # numbers of the moves, row by row

    def _written(self, move: Move, role: str, text: str):
        digest = self.digests[move.origin]
        for name in move.roles:
            line = f"{name}:" if name[0] != "=" else f"{name[1:] or role}:{text}"
            if digest is None:
                digest = hashlib.sha256(line.encode())
            else:
                digest = digest.copy()
                digest.update(f"\n{line}".encode())
        return digest

    def read(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        initial = role[:1]
        self.tops, moves, added = step(self.tops, initial if initial in TERMINALS else "", must_go, truncated)
        self.digests = [self._written(m, role, text) for m in moves]
        self.cost += added
        if moves not in _NUMBERS:
            _NUMBERS[moves] = len(_MOVES)
            _MOVES.append(moves)
        self.trail.append(_NUMBERS[moves])

    def end(self) -> tuple[int, str, str]:
        """Cost, edits in order, and the digest of the repaired text."""
        last, more = finish(self.tops)
        digest = self._written(last, "", "")
        parts, at = [last.edits], last.origin
        for number in reversed(self.trail):
            move = _MOVES[number][at]
            parts.append(move.edits)
            at = move.origin
        return self.cost + more, "".join(reversed(parts)), (digest or hashlib.sha256()).hexdigest()


#: All moves met so far in this process, and their numbers.
_MOVES: list[tuple[Move, ...]] = []
_NUMBERS: dict[tuple[Move, ...], int] = {}

_FAULTS = ("blank", "duplicate", "truncated")
_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def rows_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, lost``: nulls of role and text are one space; no row is lost."""
    space = F.lit(" ")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.lit(False).alias("lost"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` harmed by rule, a quarter of them: by crc32 of ``conv_id:turn`` some are lost, emptied, cut, repeated or reroled.

    A lost row stays as a mark of its conversation, without turn, role and text.
    """
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    harm = F.crc32(name.cast("binary")) % 20
    none = F.lit(None)
    lost = harm == 0
    text = F.when(lost, none).when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    harmed = rows.select(
        "conv_id",
        F.when(~lost, F.col("turn")).alias("turn"),
        F.when(lost, none).when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        lost.alias("lost"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return harmed.drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """``rows``, whole conversations to a partition and in order, with ``fault`` (blank, duplicate, truncated or null) and ``seen``."""
    solid = F.rtrim("text", F.lit(_SPACES))
    # The conversation's partition serves the window as well, so rows are shuffled once.
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "lost").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(solid == "", _FAULTS[0])
        .when(F.col("seen") > 1, _FAULTS[1])
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), _FAULTS[2])
    )
    found = rows.repartition("conv_id").withColumn("seen", seen).withColumn("fault", F.when(~F.col("lost"), fault))
    return found.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")


class _Counts:
    """Counts of one conversation beside its repair."""

    def __init__(self):
        self.repair = Repair()
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.illegal = self.turns = 0
        self.least = self.most = self.before = None

    def read(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in PAIRS:
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.most:  # turns come in order
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        self.repair.read(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def line(self, conv_id: int | None) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (conv_id, gaps, *self.faults.values(), self.illegal, *self.repair.end())


def repair_digest(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (as from :func:`rows_of`): its gaps, faults, cost, edits and the repaired text's digest."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    kinds = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, counts, out = None, None, []
        for batch in batches:
            for conv_id, turn, role, text, lost, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if counts is None or conv_id != conv:
                    if counts is not None:
                        out.append(counts.line(conv))
                    conv, counts = conv_id, _Counts()
                if not lost:
                    counts.read(turn, role, text, fault)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)
                out = []
        if counts is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(counts.line(conv), kinds)], schema=kinds)

    return judged(rows).select("conv_id", "turn", "role", "text", "lost", "fault").mapInArrow(run, _DIGEST)


def repaired(rows: DataFrame, digest: DataFrame) -> DataFrame:
    """The turns of the repaired conversations, by the edits in ``digest``: ``conv_id, place, turn, role, text, edit``.

    Each conversation's edits come before its rows in one stream, so that neither is sent with every row of the other.
    """
    edits = digest.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    marks = edits.withColumn("kind", F.lit(0))
    own = rows.filter(~F.col("lost")).select("conv_id", "turn", "role", "text").withColumn("kind", F.lit(1))
    stream = marks.unionByName(own).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "text")
    schema = "conv_id long, place long, turn long, role string, text string, edit string"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, before = "", 0, 0, ""
        conv = None
        for batch in batches:
            out: list[tuple] = []

            def put(turn: int | None, role: str, text: str, edit: str) -> None:
                nonlocal place, before
                out.append((conv, place, turn, role, text, edit))
                place, before = place + 1, role[:1]

            def insert() -> None:
                nonlocal at
                while at < len(audit) and audit[at] == "I":
                    put(None, "assistant" if before == "u" else "user", "", "I")
                    at += 1

            for conv_id, turn, role, text, kind in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    conv, audit, at, place, before = conv_id, text, 0, 0, ""
                else:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        put(turn, role if edit == "K" else "assistant" if before == "u" else "user", text, edit)
                insert()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in schema.split(", ")])

    return stream.select("conv_id", "turn", "role", "text", "kind").mapInArrow(run, schema)
