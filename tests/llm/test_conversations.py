"""Conversation repair against a search through all edits, and against a plain second version of its query."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from mendtable.llm import conversations

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\f\r"


def cheapest(rows):
    """All edit rows of (initial, must go, truncated) tried one by one: the least (cost, edits)."""
    best = [None]

    def inserts(roles, cost, edits):
        for n in range(3):
            for new in itertools.product("ua", repeat=n):
                yield roles + "".join(new), cost + 5 * n, edits + "I" * n

    def go(i, roles, cost, edits):
        if best[0] is not None and cost > best[0][0]:
            return
        for r, c, e in inserts(roles, cost, edits):
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", r) and (best[0] is None or (c, e) < best[0]):
                    best[0] = (c, e)
                continue
            initial, gone, cut = rows[i]
            go(i + 1, r, c + 2, e + "D")
            if not gone:
                more = 5 * cut
                if initial in ("s", "u", "a"):
                    go(i + 1, r + initial, c + more, e + "K")
                for to in "ua":
                    go(i + 1, r + to, c + 1 + more, e + "R")

    go(0, "", 0, "")
    return best[0]


def plain_edits(rows):
    """Every state's least (cost, edits) with the edits whole: for long conversations."""
    ways = {"": (0, "")}
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(found, state, way):
        if state not in found or way < found[state]:
            found[state] = way

    def inserted(ways):
        out = {}
        for state, (cost, edits) in ways.items():
            for n in range(3):
                put(out, state, (cost + 5 * n, edits + "I" * n))
                state = after[state]
        return out

    for initial, gone, cut in rows:
        found = {}
        for state, (cost, edits) in inserted(ways).items():
            put(found, state, (cost + 2, edits + "D"))
            if not gone:
                to = "s" if initial == "s" and state == "" else initial if initial == after[state] else None
                if to:
                    put(found, to, (cost + 5 * cut, edits + "K"))
                put(found, after[state], (cost + 1 + 5 * cut, edits + "R"))
        ways = found
    return min(way for state, way in inserted(ways).items() if state in ("", "a"))


def by_survivors(rows):
    ways, edits = conversations.Survivors(), b""
    for initial, gone, cut in rows:
        known = initial if initial in ("s", "u", "a") else ""
        edits += ways.advance(conversations.FORCED if gone else conversations.MOVES[known, cut])
    cost, rest = ways.finish()
    return cost, (edits + rest).decode()


def second_version(rows):
    """The query's rows for (conv_id, turn, role, text), row by row in Python."""
    found, damaged = {c: [] for c, *_ in rows}, []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        damaged += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    for conv, turn, role, text in damaged:
        found[conv].append((turn, role, text))
    out = []
    for conv, turns in found.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        seen, kinds, faults = set(), [], []
        for _, role, text in turns:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, edits = plain_edits(kinds)
        state, at, lines = "", 0, []
        after = {"": "u", "s": "u", "u": "a", "a": "u"}
        names = {"u": "user", "a": "assistant"}
        for e in edits:
            if e == "I":
                state = after[state]
                lines.append(names[state] + ":")
                continue
            _, role, text = turns[at]
            at += 1
            if e == "D":
                continue
            state = after[state] if e == "R" else role[:1]
            lines.append((names[state] if e == "R" else role) + ":" + text)
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [k[0] for k in kinds]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def compare(df, want):
    got = sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_edits_are_the_cheapest():
    dice = random.Random(3)
    for _ in range(250):
        rows = [(dice.choice("suauax"), dice.random() < 0.15, dice.random() < 0.25) for _ in range(dice.randint(0, 4))]
        assert by_survivors(rows) == cheapest(rows) == plain_edits(rows)


@pytest.mark.parametrize("roles", ["u", "ua", "s", "a", "suu", "uax", "uua", "suaaua"])
def test_long_conversations(roles):
    dice = random.Random(len(roles))
    for gone, cut in ((0, 0), (0.1, 0.1), (0.4, 0.4), (1, 0)):
        rows = [(roles[i % len(roles)], dice.random() < gone, dice.random() < cut) for i in range(400)]
        assert by_survivors(rows) == plain_edits(rows)


def test_settled_edits_leave_at_once_and_free_their_branches():
    ways, out = conversations.Survivors(), 0
    for i in range(5000):
        out += len(ways.advance(conversations.MOVES["ua"[i % 2], False]))
        assert i + 1 - out <= 4
        nodes = set()
        for node in ways.tip.values():
            while node is not None:
                nodes.add(id(node))
                node = node.parent
        assert len(nodes) <= 12


def test_query_agrees_with_second_version(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    compare(conversations.damage_and_repair(spark.read.parquet(f"{SF}/conversations.parquet")), second_version(rows))


ODD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"), (1, 1, "assistant", "Hi!"), (1, None, "user", "No number."), (1, 9, None, "no role."),
    (2, 5, "system", None), (2, 6, "user", ""), (2, 7, "tool", " \t\n"), (2, 8, "user", "cut off"), (2, 8, "assistant", "At the same turn."),
    (None, 0, "user", "No conversation."), (None, None, None, None), (3, -2, "system", "Rules."), (3, -1, "user", "Hello."), (3, 4, "user", "Hello."),
    (4, None, "user", "Same."), (4, None, "user", "Same."), (4, 3, "user", "Same."), (4, 4, "assistant", "x" * 300_000 + "."), (5, 1, "", "No role at all."),
    (6, 1, "users", "Kept as written."), (6, 2, "aide", "So is this. "), (6, 3, "süd", "nor this。"), (6, 4, "user", "End. \x0b"),
] + [(7, i, "user", f"Turn {i % 40}.") for i in range(200)]
ODD += [(100 + i, t, r, w) for i in range(40) for t, r, w in ((0, "user", "A?"), (1, "assistant", "B."))]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("digest", "kind", "copy", "n", "low", "conv_id_", "audit"):
        df = df.selectExpr("*", f"7 AS `{name}`")
    compare(conversations.damage_and_repair(df), second_version(rows))
    whole = conversations.repaired(df.filter("role IS NOT NULL"))
    assert whole.columns == ["conv_id", "place", "turn", "role", "text"]
    roles = {}
    for r in sorted(whole.collect(), key=lambda r: r.place):
        roles[r.conv_id] = roles.get(r.conv_id, "") + r.role[0]
    assert all(re.fullmatch("s?(ua)+", r) for r in roles.values()) and bool(roles) == bool(rows)
