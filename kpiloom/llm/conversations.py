"""Repair of conversations to the order of roles (system?, (user, assistant)+), or nothing, at the least cost.

Turns are put in order by a range sort, so a conversation of any length is spread over tasks, and numbered. Chunks of
consecutive turns of a conversation become short texts of symbols (see ``turngrammar``). The grammar is made from all
chunks: each round counts the pairs of symbols in all distinct chunks and names the most frequent that share no symbol.
Its rules, a bounded number, go to the tasks with one transfer table each. Chunks become tables; tables of a conversation
with many chunks are joined by a tree, ``FAN`` at a time, and the states that its cheapest edits pass are handed down
again, so no task holds more than ``FAN`` tables or one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm import turngrammar
from kpiloom.llm.common import batches, small_batches, staged, worker_cache

#: Turns of a chunk, as a power of two, and tables joined at once.
CHUNK_BITS, FAN_BITS = 10, 8
#: Rounds in which pairs are counted, and pairs named in a round.
ROUNDS, PAIRS = 8, 32
#: Chunks whose tables a worker keeps.
KEPT_TABLES = 50_000
#: Rows that are equal in all else are dealt into so many shares.
SALTS = 1024
SPACE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Repair:
    """``edits``: id, place, sub (place and sub order a conversation), turn, role, text, edit (K, R, D or I).

    ``faults``: a row per id with turns: gaps, blank, duplicate, truncated, illegal, cost.
    """

    edits: DataFrame
    faults: DataFrame


def in_order(rows: DataFrame) -> DataFrame:
    """Stored rows (id, turn, role, text) numbered by conversation and turn (``place``), with their faults and a digest."""
    head = [F.substring(c, 1, 16) for c in ("role", "text")]
    salt = (F.monotonically_increasing_id() % SALTS).cast("int")
    keyed = rows.withColumns({"role_head": head[0], "text_head": head[1], "hash": F.xxhash64("role", "text"), "salt": salt})
    order = [F.asc_nulls_first("id"), F.asc_nulls_first("turn"), "role_head", "text_head", "hash", "salt"]
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    ending = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    sized = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return staged(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
            F.monotonically_increasing_id().alias("place"), "id", "turn", "role", "text", kind.alias("kind"),
            (ending == "").alias("blank"), (~ending.isin("", ".", "!", "?")).alias("cut_off"),
            F.unhex(F.sha2(sized, 256)).alias("digest"),
        ),
        "turns",
    )


def in_chunks(turns: DataFrame, chunk_bits: int) -> DataFrame:
    """Stored chunks: id, block, symbols, kinds, places, n, blank, duplicate, truncated."""
    light = turns.select("place", "id", "kind", "blank", "cut_off", "digest")
    firsts = light.where(~F.col("blank")).groupBy("id", "digest").agg(F.min("place").alias("place"))
    marked = light.drop("digest").join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    again = ~F.col("blank") & F.col("first").isNull()
    late = ~F.col("blank") & ~again & F.col("cut_off")
    symbol = F.when(F.col("blank") | again, "x").when(late, F.upper("kind")).otherwise(F.col("kind"))
    row = F.struct("place", symbol.alias("symbol"), "kind")
    counts = [F.sum(c.cast("long")).alias(n) for n, c in (("blank", F.col("blank")), ("duplicate", again), ("truncated", late))]
    block = F.shiftright("place", chunk_bits).alias("block")
    grouped = marked.groupBy("id", block).agg(F.sort_array(F.collect_list(row)).alias("rows"), *counts)

    def text(name: str) -> Column:
        return F.array_join(F.transform("rows", lambda r: r[name]), "").alias(name + "s")

    return staged(
        grouped.select(
            "id", "block", text("symbol"), text("kind"), F.transform("rows", lambda r: r["place"]).alias("places"),
            F.size("rows").cast("long").alias("n"), "blank", "duplicate", "truncated",
        ),
        "chunks",
    )


def rules_of(chunks: DataFrame) -> list[tuple[str, str]]:
    """The grammar's rules, from the pairs in all chunks; at most ``ROUNDS`` times ``PAIRS``."""
    distinct = staged(chunks.groupBy(F.col("symbols").alias("s")).agg(F.count("*").alias("n")), "sequences")
    rules: list[tuple[str, str]] = []
    for _ in range(ROUNDS):
        now = F.col("s")
        for pair, name in rules:
            now = F.replace(now, F.lit(pair), F.lit(name))
        left = distinct.select(now.alias("s"), "n").where(F.length("s") > 1)
        pairs = left.select(
            F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr("s", i, F.lit(2)))).alias("pair"), "n"
        )
        counted = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair")
        made = turngrammar.name_pairs([r["pair"] for r in counted.limit(4 * PAIRS).collect()], len(rules), PAIRS)
        if not made:
            break
        rules += made
    return rules


def table_of(symbols: str, grammar: turngrammar.Grammar, kept: dict) -> turngrammar.Table:
    table = kept.get(symbols)
    if table is None:
        if len(kept) >= KEPT_TABLES:
            kept.clear()
        table = kept[symbols] = grammar.table(symbols)
    return table


def grammar_of(rules: list[tuple[str, str]]) -> tuple[turngrammar.Grammar, dict]:
    """This worker's grammar and tables for some rules; those of an earlier run go."""
    cache = worker_cache("grammars")
    key = tuple(rules)
    if key not in cache:
        cache.clear()
        cache[key] = turngrammar.Grammar(rules), {}
    return cache[key]


LEGAL = {"su", "ua", "au"}
#: What is known of a chunk, or of some in a row: its table, first and last role, pairs of roles in order.
NODE = "id {id}, block long, data binary, first string, last string, legal long"


def nodes_of(chunks: DataFrame, rules: list[tuple[str, str]], id_type: str) -> DataFrame:
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, kept = grammar_of(rules)
        for batch in given:
            symbols, kinds = (batch.column(c).to_pylist() for c in (2, 3))
            legal = [sum(k[i : i + 2] in LEGAL for i in range(len(k) - 1)) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([table_of(s, grammar, kept).packed() for s in symbols], pa.binary()),
                    pa.array([k[0] for k in kinds], pa.string()), pa.array([k[-1] for k in kinds], pa.string()), pa.array(legal, pa.int64()),
                ],
                ["id", "block", "data", "first", "last", "legal"],
            )

    return staged(chunks.select("id", "block", "symbols", "kinds").mapInArrow(run, NODE.format(id=id_type)), "nodes")


def members(nodes: DataFrame, *keys: Column | str) -> DataFrame:
    """Nodes of a group in order; a group has at most ``FAN`` of them."""
    return nodes.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block", "data", "first", "last", "legal"))).alias("nodes"))


def legal_of(nodes: list[dict]) -> int:
    return sum(n["legal"] for n in nodes) + sum(a["last"] + b["first"] in LEGAL for a, b in zip(nodes, nodes[1:]))


def joined_nodes(nodes: DataFrame, fan_bits: int, id_type: str) -> DataFrame:
    """One level of the tree: ``FAN`` nodes become one."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            own = batch.column(2).to_pylist()
            data = [turngrammar.all_joined(turngrammar.unpacked(n["data"]) for n in group).packed() for group in own]
            ends = [pa.array([g[at][name] for g in own], pa.string()) for at, name in ((0, "first"), (-1, "last"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary()), *ends, pa.array(map(legal_of, own), pa.int64())],
                ["id", "block", "data", "first", "last", "legal"],
            )

    above = members(nodes, "id", F.shiftright("block", fan_bits).alias("block"))
    return staged(above.mapInArrow(run, NODE.format(id=id_type)), "nodes")


#: States before and after a node, the edits that end the conversation after it, and, for whole conversations, cost and pairs.
STEP = "id {id}, block long, start int, end int, tail string, cost long, legal long"


def steps_of(grouped: DataFrame, id_type: str, whole: bool) -> DataFrame:
    """The cheapest way through each group of nodes; grouped: id, nodes, and, unless whole, start, end, tail."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "block", "start", "end", "tail", "cost", "legal"]
        for batch in given:
            origin: list[int] = []
            out: list[tuple] = []
            for at, row in enumerate(batch.select(batch.schema.names[1:]).to_pylist()):
                nodes = row["nodes"]
                tables = [turngrammar.unpacked(n["data"]) for n in nodes]
                state, end = (turngrammar.START, None) if whole else (row["start"], row["end"])
                cost, states = turngrammar.path(tables, state, end)
                for i, (node, after) in enumerate(zip(nodes, states)):
                    last = i == len(nodes) - 1
                    tail = (turngrammar.TAILS[after] if whole else row["tail"]) if last else ""
                    first = whole and i == 0
                    out.append((node["block"], state, after, tail, cost if first else None, legal_of(nodes) if first else None))
                    origin.append(at)
                    state = after
            ids = batch.column(0).take(pa.array(origin, pa.int64()))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names)

    return staged(grouped.mapInArrow(run, STEP.format(id=id_type)), "steps")


def edits_of(chunks: DataFrame, steps: DataFrame, rules: list[tuple[str, str]], id_type: str) -> DataFrame:
    """Rows id, place, sub, edit, new_role: every edit of every chunk."""
    met = steps.select(F.col("id").alias("own"), F.col("block").alias("at"), "start", "end", "tail")
    both = chunks.join(met, chunks["id"].eqNullSafe(met["own"]) & (chunks["block"] == met["at"]))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, kept = grammar_of(rules)
        for batch in given:
            for at, row in enumerate(batch.select(batch.schema.names[1:]).to_pylist()):
                text = table_of(row["symbols"], grammar, kept).edits(row["start"], row["end"]) + row["tail"]
                places, subs, letters, roles = [], [], [], []
                sub, before, last = 0, 0, len(row["places"]) - 1
                for turn, letter, role in turngrammar.applied(row["symbols"], text, row["start"]):
                    sub = sub + 1 if turn == before else 0
                    before = turn
                    places.append(row["places"][min(turn, last)])
                    subs.append(sub + 10 * (turn > last))  # what ends the conversation stands after its last turn
                    letters.append(letter)
                    roles.append(role)
                ids = batch.column(0).take(pa.array([at] * len(places), pa.int64()))
                columns = [ids, pa.array(places, pa.int64()), pa.array(subs, pa.int32()), pa.array(letters, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(roles, pa.string())], ["id", "place", "sub", "edit", "new_role"])

    light = both.select("id", "symbols", "places", "start", "end", "tail")
    return light.mapInArrow(run, f"id {id_type}, place long, sub int, edit string, new_role string")


def cheapest_steps(nodes: DataFrame, fan_bits: int, id_type: str) -> tuple[DataFrame, DataFrame]:
    """Steps of all chunks, and of whole conversations (with cost and pairs in order)."""
    levels = [nodes]
    while (levels[-1].groupBy("id").count().agg(F.max("count")).first()[0] or 0) > 1 << fan_bits:
        levels.append(joined_nodes(levels[-1], fan_bits, id_type))
    steps = top = steps_of(members(levels[-1], "id"), id_type, whole=True)
    for below in reversed(levels[:-1]):
        groups = members(below, "id", F.shiftright("block", fan_bits).alias("above"))
        above = steps.select(F.col("id").alias("own"), F.col("block").alias("at"), "start", "end", "tail")
        met = groups.join(above, groups["id"].eqNullSafe(above["own"]) & (groups["above"] == above["at"]))
        steps = steps_of(met.select("id", "nodes", "start", "end", "tail"), id_type, whole=False)
    return steps, top


def repair(
    rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    chunk_bits: int = CHUNK_BITS, fan_bits: int = FAN_BITS,
) -> Repair:
    """Faults of each conversation and the cheapest edits that bring its roles in order.

    A turn's first fault counts: blank (only white space), duplicate (its role and text stand earlier in the conversation),
    truncated (does not end with one of ``.!?``, white space aside). Edits: K keeps (0), R gives the role user or assistant
    (2), D deletes (3; blank and duplicate turns must go), I inserts an empty turn of user or assistant (2); a truncated
    turn that stays costs 1 more. The initials of the roles left read ``(s?(ua)+)?``; a role that begins with another letter
    cannot be kept. Of equally cheap edits those whose letters are least in ASCII win.

    Turns are taken by ``turn`` (whole numbers, nulls first); rows of one turn by the first 16 letters of role and text,
    then by a hash of both, so equal rows are adjacent. A null role or text counts as one space, a null id is an id of its
    own. gaps: largest less smallest turn + 1 less distinct turns, nulls aside; 0 without any, null if it fits no long.
    illegal: adjacent turns, before any edit, whose initials are not su, ua or au. Ids without rows cannot appear; an empty
    table gives no rows. Other columns are not read.
    """
    small_batches(rows.sparkSession)
    id_type = rows.schema[id_col].dataType.simpleString()

    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    turns = in_order(
        rows.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
            filled(role_col).alias("role"), filled(text_col).alias("text"),
        )
    )
    chunks = in_chunks(turns, chunk_bits)
    rules = rules_of(chunks)
    steps, top = cheapest_steps(nodes_of(chunks, rules, id_type), fan_bits, id_type)

    made = edits_of(chunks, steps, rules, id_type)
    kept = turns.select("place", "turn", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
    inserted = F.col("edit") == "I"
    edits = made.join(kept, "place").select(
        "id", "place", "sub", F.when(~inserted, F.col("turn")).alias("turn"),
        F.coalesce("new_role", "old_role").alias("role"), F.when(inserted, "").otherwise(F.col("old_text")).alias("text"), "edit",
    )

    exact = [f(F.col("turn").cast("decimal(38,0)")) for f in (F.max, F.min)]
    gaps = F.when(F.count("turn") == 0, F.lit(0).cast("long")).otherwise((exact[0] - exact[1] + 1 - F.count("turn")).try_cast("long"))
    spans = turns.select("id", "turn").distinct().groupBy("id").agg(gaps.alias("gaps"))
    sums = chunks.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("n", "blank", "duplicate", "truncated")])
    ways = top.where("cost is not null").select("id", "cost", "legal")
    names = ("n", "blank", "duplicate", "truncated", "gaps", "cost", "legal")
    together = None
    for part in (spans, sums, ways):
        part = part.select("id", *[(F.col(c) if c in part.columns else F.lit(None)).cast("long").alias(c) for c in names])
        together = part if together is None else together.unionByName(part)
    faults = together.groupBy("id").agg(*[F.max(c).alias(c) for c in names])
    return Repair(
        edits, faults.select("id", "gaps", "blank", "duplicate", "truncated", (F.col("n") - 1 - F.col("legal")).alias("illegal"), "cost")
    )


def digests(edits: DataFrame) -> DataFrame:
    """Per id: audit (the edits' letters in order) and repaired_sha256 (``role:text`` of what is left, joined by line feeds).

    A digest can only be made in order, so a conversation's turns pass one task, row by row; nothing but the letters is kept.
    """
    id_type = edits.schema["id"].dataType.simpleString()
    small_batches(edits.sparkSession)
    schema = pa.schema(
        [("id", to_arrow_type(edits.schema["id"].dataType)), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def rows() -> Iterator[tuple]:
            begun, letters, hashed, glue = [], [], None, ""
            for batch in given:
                for own, letter, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if begun != [own]:
                        if begun:
                            yield begun[0], "".join(letters), hashed.hexdigest()
                        begun, letters, hashed, glue = [own], [], hashlib.sha256(), ""
                    letters.append(letter)
                    if letter != "D":
                        hashed.update(f"{glue}{role}:{text}".encode())
                        glue = "\n"
            if begun:
                yield begun[0], "".join(letters), hashed.hexdigest()

        yield from batches(rows(), schema)

    ordered = edits.repartition("id").sortWithinPartitions("id", "place", "sub")
    return ordered.select("id", "edit", "role", "text").mapInArrow(run, f"id {id_type}, audit string, repaired_sha256 string")
