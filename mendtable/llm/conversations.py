"""Conversation structure repair by survivor-coalescence Viterbi.

A sound conversation has roles whose initials read ``(s?(ua)+)?``. Rows may be kept (cost 0), given the
role user or assistant (1) or deleted (2), and rows of empty text may be inserted (5); blank and
repeated rows must go, and a truncated row that stays costs 5 more. The cheapest edits are wanted, and of
several the row of initials (Delete, Insert, Keep, Rerole) that is least in ASCII.

Rows come in order, and for each state of the pattern the best way into it survives. Survivors hang in
a tree of backpointers with reference counts: a branch nobody holds is freed, and once all survivors
share an ancestor, the edits up to it are handed out with the rows they concern, whose texts are then
forgotten. A survivor that another one beats by more than any rest of the conversation can make good is
dropped, so that the ways grow together soon. Equal costs are told apart by the complete unresolved
edits of both; for each pair of survivors is known which one comes first, or by which inserts one
exceeds the other, so that the comparison of what was added last decides for all of it.

Order: by turn, nulls first, then by role and by digest of the text. Rows equal in all of these are
repeats. Repeats farther apart are found by aggregation, so that no task holds a conversation's texts:
a task streams through the sorted rows of its conversations and holds the unresolved ones. The digest of
a conversation's repaired rows is one sequence of bytes, so one task makes it, however long it is.

A null role or text is one space (so the row is blank), a null turn stays null, all rows with a null
conversation id are one conversation. A role without letters has no initial and cannot be kept. Texts
may be empty or very long; one row's text is the least that is held. An empty table gives an empty one.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mendtable.functions.columns import ref

from .common import prepared, stored, task

# fixed values: costs of the edits, and the states of the pattern (nothing yet, after a system, a user
# and an assistant row)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\f\r"

_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that end a conversation properly.
_CLOSING = {EMPTY: b"", SYSTEM: b"II", USER: b"I", ASSISTANT: b""}
#: What the second state pays at most to go on as the first one would: inserts, or a system row deleted.
_CATCH_UP = {
    EMPTY: {ASSISTANT: DELETE, USER: INSERT + DELETE, SYSTEM: 2 * INSERT},
    SYSTEM: {EMPTY: 0, ASSISTANT: 0, USER: INSERT},
    USER: {EMPTY: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {EMPTY: 0, USER: INSERT, SYSTEM: 2 * INSERT},
}

Move = tuple[int, int, int, bytes]


def _kept_to(state: int, initial: str) -> int | None:
    """The state after a row is kept, if the pattern allows it."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    to = _NEXT[state]
    return to if _ROLE[to][0] == initial else None


def _moves(initial: str, cut: bool) -> list[Move]:
    """All ways past a row: (from, to, cost, edits); at most two inserts before it can be of use."""
    found: dict[tuple[int, int], tuple[int, bytes]] = {}
    for start in range(4):
        ways = [(start, DELETE, b"D")]
        state, paid, edits = start, 0, b""
        for _ in range(3):
            extra = CUT if cut else 0
            if (to := _kept_to(state, initial)) is not None:
                ways.append((to, paid + KEEP + extra, edits + b"K"))
            ways.append((_NEXT[state], paid + REROLE + extra, edits + b"R"))
            state, paid, edits = _NEXT[state], paid + INSERT, edits + b"I"
        for to, cost, way in ways:
            if (start, to) not in found or (cost, way) < found[start, to]:
                found[start, to] = (cost, way)
    return [(a, b, cost, way) for (a, b), (cost, way) in found.items()]


MOVES = {(initial, cut): _moves(initial, cut) for initial in ("s", "u", "a", "") for cut in (False, True)}
FORCED: list[Move] = [(state, state, DELETE, b"D") for state in range(4)]


class _Node:
    """Edits shared by all survivors below; ``held`` counts the nodes and survivors that hang on it."""

    __slots__ = ("parent", "edits", "held")

    def __init__(self, parent: _Node | None, edits: bytes):
        self.parent, self.edits, self.held = parent, bytearray(edits), 1


class Survivors:
    """The best way into each state, and what is common to all of them."""

    def __init__(self):
        self.root = _Node(None, b"")
        self.cost = {EMPTY: 0}
        self.tip = {EMPTY: _Node(self.root, b"")}
        # for two states: below or above zero if the first's edits come first or second, or else the
        # edits by which the first's and the second's exceed what they share, one of them empty
        self.order: dict[tuple[int, int], int | tuple[bytes, bytes]] = {}

    def _compared(self, x: int, more_x: bytes, y: int, more_y: bytes) -> int | tuple[bytes, bytes]:
        """The order of the complete edits of two ways, each a survivor and what it adds."""
        if x != y:
            known = self.order[x, y]
            if isinstance(known, int):
                return known
            more_x, more_y = known[0] + more_x, known[1] + more_y
        if more_x.startswith(more_y):
            return more_x[len(more_y) :], b""
        if more_y.startswith(more_x):
            return b"", more_y[len(more_x) :]
        return -1 if more_x < more_y else 1

    def _better(self, way: tuple[int, int, bytes], than: tuple[int, int, bytes]) -> bool:
        if way[0] != than[0]:
            return way[0] < than[0]
        order = self._compared(way[1], way[2], than[1], than[2])
        return order < 0 if isinstance(order, int) else len(order[0]) < len(order[1])

    def advance(self, moves: Iterable[Move]) -> bytes:
        """Pass one row; the edits that are settled by it."""
        best: dict[int, tuple[int, int, bytes]] = {}
        for x, y, price, edits in moves:
            if x in self.cost:
                way = (self.cost[x] + price, x, edits)
                if y not in best or self._better(way, best[y]):
                    best[y] = way
        if len(best) > 1:
            costs = {y: way[0] for y, way in best.items()}
            for y, cost in costs.items():
                if any(z in costs and costs[z] + gap < cost for z, gap in _CATCH_UP[y].items()):
                    del best[y]
        order = {}
        for y, (_, x, more) in best.items():
            for z, (_, w, other) in best.items():
                if y != z:
                    order[y, z] = self._compared(x, more, w, other)
        self.order = order
        self.cost = {y: way[0] for y, way in best.items()}
        self._grow(best)
        return self._settled()

    def _grow(self, best: dict[int, tuple[int, int, bytes]]) -> None:
        children: dict[int, int] = {}
        for _, x, _ in best.values():
            children[x] = children.get(x, 0) + 1
        tips = {}
        for y, (_, x, edits) in best.items():
            node = self.tip[x]
            if children[x] == 1:
                node.edits += edits
                tips[y] = node
            else:
                tips[y] = _Node(node, edits)
        for x, node in self.tip.items():
            node.held = children.get(x, 0)
            while node.held == 0 and node.parent is not None:
                node = node.parent
                node.held -= 1
        self.tip = tips

    def _settled(self) -> bytes:
        out = b""
        while self.root.held == 1:
            node = next(iter(self.tip.values()))
            is_tip = len(self.tip) == 1 and node.parent is self.root
            while node.parent is not self.root:
                node = node.parent
            out += node.edits
            node.edits = bytearray()
            if is_tip or any(tip is node for tip in self.tip.values()):
                break
            node.parent, self.root = None, node
        return out

    def finish(self) -> tuple[int, bytes]:
        """The least cost, and the edits not handed out yet."""
        best: tuple[int, int, bytes] | None = None
        for x, cost in self.cost.items():
            way = (cost + INSERT * len(_CLOSING[x]), x, _CLOSING[x])
            if best is None or self._better(way, best):
                best = way
        parts, node = [best[2]], self.tip[best[1]]
        while node is not None and node is not self.root:
            parts.append(bytes(node.edits))
            node = node.parent
        return best[0], b"".join(reversed(parts))


class Conversation:
    """One conversation, row by row: its faults, its edits, and its repaired rows as they are settled."""

    def __init__(self):
        self.ways = Survivors()
        self.waiting: deque[tuple[int | None, str, str]] = deque()
        self.state, self.audit = EMPTY, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high = 0, None, None
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> Iterator[tuple[int | None, str, str]]:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        stripped = text.rstrip(SPACES)
        if not stripped:
            self.blank += 1
            moves = FORCED
        elif repeated:
            self.duplicate += 1
            moves = FORCED
        else:
            cut = stripped[-1] not in ".!?"
            self.truncated += cut
            moves = MOVES[initial if initial in "sua" else "", cut]
        self.waiting.append((turn, role, text))
        yield from self._apply(self.ways.advance(moves))

    def _apply(self, edits: bytes) -> Iterator[tuple[int | None, str, str]]:
        self.audit += edits
        for edit in edits.decode():
            if edit == "I":
                self.state = _NEXT[self.state]
                yield None, _ROLE[self.state], ""
                continue
            turn, role, text = self.waiting.popleft()
            if edit == "K":
                self.state = _kept_to(self.state, role[:1])
            elif edit == "R":
                self.state = _NEXT[self.state]
                role = _ROLE[self.state]
            if edit != "D":
                yield turn, role, text

    def finish(self) -> Iterator[tuple[int | None, str, str]]:
        self.cost, edits = self.ways.finish()
        yield from self._apply(edits)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


# ------------------------------------------------------------------ tables


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults of every sort, by crc32 of ``conversation:turn`` modulo 20: 0 drops a row, 1 empties
    its text, 2 removes the marks that end sentences, 3 repeats it, 4 makes it a user's. Nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(ref(c).cast("string"), F.lit(" ")) for c in (conversation, turn)])
    fault = F.crc32(key) % 20
    words = F.coalesce(ref(text), F.lit(" "))
    return rows.filter(fault != 0).select(
        ref(conversation).alias("conv_id"), ref(turn).alias("turn"),
        F.when(fault == 4, "user").otherwise(F.coalesce(ref(role), F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(words, "[.!?]", "")).otherwise(words).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES)) == ""


def _stream(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows (conv_id, turn, role, text, kind) as the tasks read them, conversations in order: 0 names a
    conversation, 1 says that the row that follows was seen earlier, 2 is a row."""
    prepared(rows.sparkSession)
    order = ["conv_id", "turn", "role", "digest"]
    given = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # texts stay behind: what is compared are digests, each turn's once
    light = stored(given.filter(~_blank(F.col("text"))).select(order).distinct(), "turns")
    keys = ["conv_id", "role", "digest"]
    several = light.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(
        F.min("turn").alias("low"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.count("*").alias("n")
    ).filter("n > 1")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"{k}_"))
    first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("low"))
    again = light.join(several, match).filter(~first)
    named = (given if ids is None else ids).select("conv_id").distinct()
    null = F.lit(None)
    parts = [
        named.select("conv_id", null.cast("bigint").alias("turn"), null.cast("string").alias("role"), null.cast("string").alias("text"), null.cast("binary").alias("digest"), F.lit(0).alias("kind")),
        again.select("conv_id", "turn", "role", null.cast("string").alias("text"), "digest", F.lit(1).alias("kind")),
        given.select("conv_id", "turn", "role", "text", "digest", F.lit(2).alias("kind")),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in [*order, "kind"]])


Event = tuple[object, "Conversation", "tuple[int | None, str, str] | None"]


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[Event]:
    """Repaired rows as they are settled, and after the last of each conversation none."""
    now: Conversation | None = None
    conv, before, marked = None, None, None
    for batch in batches:
        for key, turn, role, text, digest, kind in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or key != conv:
                if now is not None:
                    for item in now.finish():
                        yield conv, now, item
                    yield conv, now, None
                now, conv, before, marked = Conversation(), key, None, None
            if kind == 1:
                marked = (turn, role, digest)
            elif kind == 2:
                place = (turn, role, digest)
                for item in now.add(turn, role, text, place in (before, marked)):
                    yield conv, now, item
                before = place
    if now is not None:
        for item in now.finish():
            yield conv, now, item
        yield conv, now, None


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Rows, and characters of text, of a batch that a task hands out.
ROWS, LETTERS = 4096, 1 << 20


def _told(source: DataFrame, results: Callable[[Iterator[Event]], Iterator[tuple]], columns: str) -> DataFrame:
    """What tasks tell of their conversations: a table of conv_id and ``columns``."""
    kind = source.schema["conv_id"].dataType
    names = T.StructType().add("conv_id", kind)
    for field in T.StructType.fromDDL(columns).fields:
        names = names.add(field)
    schema = to_arrow_schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in results(_events(batches)):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, str))
            if len(held) >= ROWS or size >= LETTERS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return source.mapInArrow(task(run), names)


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text), or of ``ids`` if given: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit and repaired_sha256."""

    def results(events: Iterator[Event]) -> Iterator[tuple]:
        digest, started = hashlib.sha256(), False
        for conv, now, item in events:
            if item is not None:
                digest.update(("\n" * started + item[1] + ":" + item[2]).encode())
                started = True
                continue
            yield conv, *[getattr(now, c) for c in _COUNTS], now.audit.decode(), digest.hexdigest()
            digest, started = hashlib.sha256(), False

    columns = ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return _told(_stream(rows, ids), results, columns)


def repaired(rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place (from 0), turn (null for inserted rows), role, text."""

    def results(events: Iterator[Event]) -> Iterator[tuple]:
        place = 0
        for conv, _, item in events:
            if item is None:
                place = 0
                continue
            yield conv, place, *item
            place += 1

    return _told(_stream(rows, None), results, "place bigint, turn bigint, role string, text string")


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """The audits of damaged conversations, those included of which no row is left."""
    return audits(damaged(rows), rows)
