"""Repaired conversations against a plain search over all edits."""

import hashlib
import heapq
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import difference
from kpiloom.llm import conversations, queries, turngrammar

WANTED = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def begins(initials):
    """Whether more turns can bring these initials to the wanted order."""
    return any(WANTED.fullmatch(initials + rest) for rest in ("", "ua", "a"))


def search(turns):
    """(cost, edits, [(role, text)]) by trying every edit of every turn in order of cost and letters; turns: (role, text, must go, truncated)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, at, initials, out = heapq.heappop(heap)
        tail = initials[:1] + initials[1:][-2:]  # enough to tell what may follow
        key = at, tail if initials else "", bool(WANTED.fullmatch(initials))
        if key in done:
            continue
        done.add(key)
        if at == len(turns) and WANTED.fullmatch(initials):
            return cost, edits, list(out)
        ways = [(2, "I", at, r, "") for r in ("user", "assistant")]
        if at < len(turns):
            role, text, gone, late = turns[at]
            ways.append((3, "D", at + 1, "", ""))
            if not gone:
                ways += [(2 + late, "R", at + 1, r, text) for r in ("user", "assistant")] + [(int(late), "K", at + 1, role, text)]
        for price, letter, then, role, text in ways:
            after = initials + role[:1]
            if letter == "D" or (role[:1] and begins(after)):
                heapq.heappush(heap, (cost + price, edits + letter, then, after, (*out, (role, text)) if letter != "D" else out))


def plain(rows):
    """Per id: gaps, blank, duplicate, truncated, illegal, cost, edits, text of what is left. rows: (id, turn, role, text)."""
    out = {}
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, counts, given = set(), [0, 0, 0], []
        for _, role, text in turns:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            given.append((role, text, fault in (0, 1), fault == 2))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, edits, left = search(given)
        out[conv] = (gaps, *counts, illegal, cost, edits, "\n".join(f"{r}:{t}" for r, t in left))
    return out


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", place int, edit string, `a.b` string").repartition(3)
    repaired = conversations.repair(df, **settings)
    faults = {r.id: tuple(r)[1:] for r in repaired.faults.collect()}
    digests = {r.id: r for r in conversations.digests(repaired.edits).collect()}
    edits = defaultdict(list)
    for r in sorted(repaired.edits.collect(), key=lambda r: (r.id is not None, r.id or 0, r.place, r["sub"])):
        edits[r.id].append(r)
    out = {}
    for conv, own in edits.items():
        text = "\n".join(f"{r.role}:{r.text}" for r in own if r.edit != "D")
        letters = "".join(r.edit for r in own)
        assert (digests[conv].audit, digests[conv].repaired_sha256) == (letters, hashlib.sha256(text.encode()).hexdigest())
        out[conv] = (*faults[conv], letters, text)
    assert set(out) == set(faults)
    return out


TURN = st.tuples(st.sampled_from("suaot"), st.booleans(), st.booleans())


@given(st.lists(TURN, min_size=1, max_size=9), st.lists(st.lists(TURN, min_size=2, max_size=9), max_size=4), st.integers(1, 3))
@settings(max_examples=150, deadline=None)
def test_tables_of_a_grammar(turns, others, named):
    words = [
        "".join("x" if gone else (r if r in "sua" else "o") if not late else (r if r in "sua" else "o").upper() for r, gone, late in t)
        for t in [turns, *others]
    ]
    rules, now = [], words
    for _ in range(4):  # pairs of all words are named, the most frequent first
        counts = defaultdict(int)
        for w in now:
            for i in range(len(w) - 1):
                counts[w[i : i + 2]] += 1
        made = turngrammar.name_pairs(sorted(counts, key=lambda p: (-counts[p], p)), len(rules), named)
        rules += made
        for pair, name in made:
            now = [w.replace(pair, name) for w in now]
    table = turngrammar.Grammar(rules).table(words[0])
    cost, (end,) = turngrammar.path([table], turngrammar.START, None)
    edits = table.edits(turngrammar.START, end) + turngrammar.TAILS[end]
    expected = search([(r, "", gone, late and not gone) for r, gone, late in turns])
    assert (cost, edits) == expected[:2]
    # split anywhere, ranks alone find the same way
    tables = [turngrammar.unpacked(turngrammar.Grammar([]).table(s).packed()) for s in words[0]]
    total, states = turngrammar.path(tables, turngrammar.START, None)
    assert total == cost
    texts = [turngrammar.of_symbol(s).edits(a, b) for s, a, b in zip(words[0], [0, *states], states)]
    assert "".join(texts) + turngrammar.TAILS[states[-1]] == edits


def conversation(rng, conv, n):
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why? ", "x ", "long " * 5 + "end.", None]
    roles = ["user", "assistant", "system", "tool", "User", "", None, "summary"]
    kind = rng.choice([roles, ["user", "assistant"], ["system", "user", "assistant"]])
    return [
        (conv, None if rng.random() < 0.05 else i + rng.choice([0, 0, 0, 2]), rng.choice(kind), f"{rng.choice(texts) or ''}") for i in range(n)
    ]


@pytest.mark.parametrize("chunk_bits, fan_bits", [(10, 8), (2, 2)])
def test_against_search(spark, chunk_bits, fan_bits):
    rng = random.Random(4)
    rows = [row for conv in range(60) for row in conversation(rng, conv, rng.randint(1, 14))]
    rows += [(None, i, r, t) for _, i, r, t in conversation(rng, 0, 9)]
    got = run(spark, rows, chunk_bits=chunk_bits, fan_bits=fan_bits)
    assert got == plain(rows)


def test_long_conversations_go_through_the_tree(spark, monkeypatch):
    rng = random.Random(9)
    rows = conversation(rng, 1, 300) + conversation(rng, 2, 5) + [(3, None, "user", "Same.")] * 90 + [(4, i, "user", "again") for i in range(70)]
    rows += [(r[0], r[1], r[2], f"{i}{r[3]}") if r[0] == 1 and i % 3 else r for i, r in enumerate(rows)][:300]
    levels = []
    own = conversations.joined_nodes
    monkeypatch.setattr(conversations, "joined_nodes", lambda *a: levels.append(1) or own(*a))
    got = run(spark, rows, chunk_bits=2, fan_bits=3)
    assert levels and got == plain(rows)


def test_empty_and_extreme(spark):
    assert run(spark, []) == {}
    far = [(1, 2**63 - 1, "user", "a."), (1, -(2**63), "assistant", "b.")]
    assert run(spark, far)[1][0] is None
    big = "x" * 3_000_000 + "."
    got = run(spark, [(1, 0, "user", big), (1, 1, "user", big)])
    assert got[1] == plain([(1, 0, "user", big), (1, 1, "user", big)])[1]


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [row for conv in range(80) for row in conversation(rng, conv, rng.randint(1, 8))]
    rows += [(None, 1, "user", "Hm."), (None, None, None, None), (200, None, "user", None), (1000, None, "user", "gone?")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    _, problem = difference(queries.op11_conversation_repair(spark, str(tmp_path)), con, queries.OP11_SQL)
    assert problem is None, problem


def test_all_rows_dropped(spark, tmp_path):
    import zlib

    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
