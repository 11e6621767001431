"""Cheapest edits of a sequence of turns, over a grammar of turn sequences.

A turn is a symbol: its role's initial (s, u, a, o for any other), upper case if its text is truncated, or x if it must be
deleted. A grammar of pairs (Re-Pair) names what sequences share. Each symbol and each rule has one transfer table: the
least cost of leading one state of the wanted order of roles to another, and the edits that do it. Tables are joined as
matrices over (min, +), bottom-up, once per rule.

Of equally cheap edits the ones least in ASCII win. Edits from one state to two different states differ, and neither begins
the other: both name every turn once (K, R or D) and end with one, and they fix the state they lead to. So a table only
ranks the states that each state leads to, and joined tables compare ranks, never texts. The edits themselves are a rope:
a joined table keeps the state in the middle, and texts are put together when they are asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a new turn, or one that gets another role, leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Where a kept turn leads, by its role.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SYMBOLS = "suaoSUAOx"
#: Edits and cost that end a sequence, by state: all but a system turn without any other may end after an assistant or at once.
TAILS = ("", "II", "I", "")
NEVER = 1 << 60
#: Rules are named by letters for private use.
FIRST_RULE = 0xE000


class Table:
    """Costs and ranks from state to state (4 * from + to), and how to put the edits together."""

    __slots__ = ("cost", "rank", "via", "left", "right", "texts")

    def __init__(self, cost: Sequence[int], rank: Sequence[int], via=None, left=None, right=None, texts=None) -> None:
        self.cost, self.rank, self.via, self.left, self.right = cost, rank, via, left, right
        self.texts: dict[int, str] = texts if texts is not None else {}

    def edits(self, start: int, end: int) -> str:
        at = 4 * start + end
        text = self.texts.get(at)
        if text is None:
            middle = self.via[at]
            text = self.texts[at] = self.left.edits(start, middle) + self.right.edits(middle, end)
        return text

    def packed(self) -> bytes:
        return struct.pack("<16q16b", *self.cost, *self.rank)


def unpacked(data: bytes) -> Table:
    values = struct.unpack("<16q16b", data)
    return Table(values[:16], values[16:])


def ranked(keys: dict[int, tuple | str]) -> list[int]:
    """Place of each of the four states among those that are reached, by their keys."""
    order = sorted(keys, key=keys.__getitem__)
    return [order.index(j) if j in keys else 0 for j in range(4)]


def of_symbol(symbol: str) -> Table:
    cost, rank, texts = [NEVER] * 16, [], {}
    own, late = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, before = start, ""
        for inserted in range(4):
            ways = [(state, DELETE, "D")]
            if own != "x":
                ways.append((NEXT[state], REROLE + late, "R"))
                if state in KEPT[own]:
                    ways.append((KEPT[own][state], late, "K"))
            for end, price, letter in ways:
                way = (INSERT * inserted + price, before + letter)
                best[end] = min(best.get(end, way), way)
            state, before = NEXT[state], before + "I"
        for end, (price, text) in best.items():
            cost[4 * start + end] = price
            texts[4 * start + end] = text
        rank += ranked({end: text for end, (_, text) in best.items()})
    return Table(cost, rank, texts=texts)


def joined(left: Table, right: Table) -> Table:
    """The table of ``left`` followed by ``right``."""
    cost, rank, via = [NEVER] * 16, [], [0] * 16
    for start in range(0, 16, 4):
        keys = {}
        for end in range(4):
            best = NEVER, 0, 0
            for middle in range(4):
                price = left.cost[start + middle] + right.cost[4 * middle + end]
                if price < NEVER:
                    best = min(best, (price, left.rank[start + middle], middle))
            if best[0] < NEVER:
                cost[start + end], first, middle = best
                via[start + end] = middle
                keys[end] = first, right.rank[4 * middle + end]
        rank += ranked(keys)
    return Table(cost, rank, via, left, right)


def all_joined(tables: Iterable[Table]) -> Table:
    """The tables one after another, joined in pairs, so ropes are as deep as the logarithm of their number."""
    tables = list(tables)
    while len(tables) > 1:
        pairs = [joined(a, b) for a, b in zip(tables[::2], tables[1::2])]
        tables = pairs + tables[len(pairs) * 2 :]
    return tables[0]


class Grammar:
    """Rules (pair, name) in the order they were made, with one table each."""

    def __init__(self, rules: Sequence[tuple[str, str]]) -> None:
        self.rules = rules
        self.tables = {s: of_symbol(s) for s in SYMBOLS}
        for pair, name in rules:
            self.tables[name] = joined(self.tables[pair[0]], self.tables[pair[1]])

    def table(self, symbols: str) -> Table:
        for pair, name in self.rules:
            symbols = symbols.replace(pair, name)
        return all_joined(map(self.tables.__getitem__, symbols))


def name_pairs(pairs: Iterable[str], made: int, most: int) -> list[tuple[str, str]]:
    """Rules for the first pairs that share no symbol: replacing them in any order gives the same sequences."""
    used: set[str] = set()
    rules = []
    for pair in pairs:
        if not used & set(pair) and len(rules) < most:
            used |= set(pair)
            rules.append((pair, chr(FIRST_RULE + made + len(rules))))
    return rules


def path(tables: Sequence[Table], start: int, end: int | None) -> tuple[int, list[int]]:
    """Least cost of all tables in a row, and the state after each; ``end`` None: anywhere, with the tail's cost."""
    last = [INSERT * len(t) for t in TAILS] if end is None else [0 if s == end else NEVER for s in range(4)]
    rest = [last]
    for table in reversed(tables):
        rest.append([min(table.cost[4 * s + m] + rest[-1][m] for m in range(4)) for s in range(4)])
    rest.reverse()
    state, states = start, []
    for table, after in zip(tables, rest[1:]):
        ways = [(table.cost[4 * state + m] + after[m], table.rank[4 * state + m], m) for m in range(4)]
        state = min(w for w in ways if w[0] < NEVER)[2]
        states.append(state)
    return rest[0][start], states


def applied(symbols: str, edits: str, state: int) -> Iterator[tuple[int, str, str | None]]:
    """(number of the turn it belongs to, edit, new role) of every edit; inserted turns belong to the one after them."""
    at = 0
    for letter in edits:
        role = None
        if letter in "IR":
            state = NEXT[state]
            role = ROLES[state]
        elif letter == "K":
            state = KEPT[symbols[at].lower()][state]
        yield at, letter, role
        at += letter != "I"
