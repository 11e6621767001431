"""Mixing of sources to target weights: copies of documents by pivotal dependent rounding.

A document of a source with rate r (target over size of the source) is due r copies: the whole part is given, the
fraction is rounded so that the source's words stay where they are. Two fractions meet: a random direction is drawn and
words move from one to the other until one fraction is 0 or 1, which is final; the chance of each direction keeps both
expectations, the moved words keep their sum. What is left of a group of documents, one fraction, meets the rest of other
groups on the next level of a tree, and last some documents that waited, until a source has one fraction left. Everything
is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import as_rows, named, staged
from kpiloom.operators.ranking import with_places

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and so a document, is taken at most so often.
MAX_REPEAT = 3
#: Fractions that meet in one group of the tree.
FAN_IN = 16

#: Fractions of a source that the rest of its tree meets last, about.
LATE = 1024
#: Equal rows that are written out at once.
SPAN = 10_000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words (runs without ASCII white space) of a text; null: none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """From rows (source, size): source, n, source_size, target; a row per source, the null source among them.

    Sources by code point, null last, share the words of all by weight; none gets more than ``max_repeat`` times its own,
    and what is too much for some is shared by the others until none is above. Sources may be many (hosts): they are
    numbered by a range sort, and each sharing is one sum over them, so no task holds all.
    """
    by_source = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    placed = with_places(by_source, [F.col("source").asc_nulls_last()], "place")
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_repeat).cast("double")
    weighted = staged(placed.select("source", "n", "source_size", choice.alias("weight"), cap.alias("cap")), "sources")
    level, full = 0.0, -1
    while True:  # each round fills at least one more source
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        row = weighted.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, F.col("cap"))).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"), F.count(F.when(above, 1)).alias("full"),
        ).first()
        if not row["open"] or row["full"] == full:
            break
        full, level = row["full"], (row["all"] - (row["given"] or 0.0)) / row["open"]
    target = F.least("cap", F.lit(level) * F.col("weight"))
    return weighted.select("source", "n", "source_size", target.alias("target"))


def met(acc: Column, x: Column) -> Column:
    """The next state after fraction ``x`` meets the carried one: carry, and done with the one that became whole."""
    c = acc["carry"]
    a, p, b, q = c["size"], c["f"], x["size"], x["f"]
    to_one, to_zero, gives, takes = a * (1 - p), a * p, b * q, b * (1 - q)
    up, down = F.least(to_one, gives), F.least(to_zero, takes)
    rises = x["u"] * (up + down) < down
    p2 = F.when(rises, F.when(to_one <= gives, 1.0).otherwise(p + gives / a)).otherwise(
        F.when(to_zero <= takes, 0.0).otherwise(p - takes / a)
    )
    q2 = F.when(rises, F.when(gives <= to_one, 0.0).otherwise(q - to_one / b)).otherwise(
        F.when(takes <= to_zero, 1.0).otherwise(q + to_zero / b)
    )
    carry, other = c.withField("f", p2), x.withField("f", q2)
    settled = (p2 <= 0.0) | (p2 >= 1.0)
    done = F.concat(acc["done"], F.array(F.when(settled, carry).otherwise(other)))
    return F.struct(F.when(settled, other).otherwise(carry).alias("carry"), done.alias("done"))


def rounded(items: DataFrame) -> DataFrame:
    """Round the fractions of ``items`` (source, groups, slot, late, item: struct of size, u, key, f with 0 < f < 1): source, item.

    ``groups`` is the number of groups of the source, ``slot`` the item's group; ``late`` items, about ``LATE`` of a source
    at most, wait for the rest of its tree. f is 0 or 1 in the result. One shuffle of all items, then a tree over one rest
    per group; a group of the tree holds at most ``FAN_IN`` rests. In a group large documents meet first and small ones
    last; at the end the rest of the tree meets the late ones, so what is left of a source is a small document. That one
    goes to the nearer side: a source is off its target by half of it.
    """
    late, items = items.where("late").select("source", "item"), items.where("not late")
    most = items.agg(F.max("groups")).first()[0]
    out, level = [], 0

    def fold(grouped: DataFrame, *keys: str) -> DataFrame:
        listed = grouped.groupBy(*keys).agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        first = F.struct(F.col("items")[0].alias("carry"), F.slice("items", 1, 0).alias("done"))
        folded = F.aggregate(F.slice("items", F.lit(2), F.size("items")), first, met)
        done = staged(listed.select(*keys, folded.alias("s")), f"rounded-{level}")
        out.append(done.select("source", F.explode("s.done").alias("item")))
        return done.select(*keys, F.col("s.carry").alias("item"))

    while most:
        carried = fold(items, "source", "groups", "slot")
        level += 1
        if most == 1:
            late = late.unionByName(carried.select("source", "item"))
            break
        again = F.col("item").withField("u", uniform(F.col("item.u"), F.lit(level)))
        items = carried.select(
            "source", F.ceil(F.col("groups") / FAN_IN).alias("groups"), F.floor(F.col("slot") / FAN_IN).alias("slot"), again.alias("item")
        )
        most = -(-most // FAN_IN)
    again = F.col("item").withField("u", uniform(F.col("item.u"), F.lit(-1)))
    last = fold(late.select("source", again.alias("item")), "source")
    nearest = F.col("item").withField("f", F.when(F.col("item.f") >= 0.5, 1.0).otherwise(0.0))
    whole = last.select("source", nearest.alias("item"))
    for part in out:
        whole = whole.union(part)
    return whole


def uniform(*parts: Column) -> Column:
    """A number from 0 up to 1 that depends on ``parts`` alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0
) -> DataFrame:
    """How often the mix takes documents: doc_id, source, size, source_size, target, n_rows, n_copies.

    Rows equal in id, source and size are one line with their number; n_copies are the copies of all of them together.
    A null text has size 0, a null source is a source, a null id an id like others. Documents without words take no part
    in the rounding, their copies are rounded alone. Reruns agree: chance is a hash of id, size and ``seed``.
    """
    rows = docs.select(named(id_col).alias("doc_id"), named(source_col).alias("source"), word_count(named(text_col)).alias("size"))
    lines = staged(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n_rows")), "sizes")
    per_source = lines.select("source", (F.col("size") * F.col("n_rows")).alias("size"))
    shares = staged(targets(per_source), "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = (
        lines.join(shares, F.col("source").eqNullSafe(F.col("of")), "left")
        .drop("of")
        .withColumn("due", F.col("n_rows") * rate)
        .withColumn("whole", F.floor("due"))
        .withColumn("f", F.when(F.col("size") > 0, F.col("due") - F.col("whole")).otherwise(F.round(F.col("due") - F.col("whole"))))
    )
    names = ["doc_id", "source", "size", "source_size", "target", "n_rows", "whole"]
    settled = due.where("f <= 0 or f >= 1").select(*names, "f")
    key = F.struct(*[F.col(n) for n in names if n not in ("source", "size")])
    mark = F.xxhash64("doc_id", "size", F.lit(seed))
    groups = F.ceil(F.col("n") / FAN_IN)
    open_items = due.where("f > 0 and f < 1").select(
        "source",
        groups.alias("groups"),
        F.pmod(mark, groups).alias("slot"),
        (uniform(mark, F.lit("late")) * F.col("n") < LATE).alias("late"),
        F.struct(F.col("size").cast("double").alias("size"), uniform(mark).alias("u"), key.alias("key"), "f").alias("item"),
    )
    done = rounded(open_items).select(
        "item.key.doc_id", "source", F.col("item.size").cast("long").alias("size"), "item.key.source_size", "item.key.target",
        "item.key.n_rows", "item.key.whole", "item.f",
    )
    return settled.unionByName(done).withColumn("n_copies", (F.col("whole") + F.col("f")).cast("long")).drop("whole", "f")


def mix(docs: DataFrame, **columns: object) -> DataFrame:
    """A row for every row of ``docs``: doc_id, source, size, source_size, target, n_copies, taken (words, repeats counted).

    Rows of one line of ``copies`` share its copies as evenly as can be. An empty table gives no rows.
    """
    spans = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_rows") - 1) / SPAN)))  # no array as long as a hot line
    first = F.col("span") * SPAN + 1
    each = F.explode(F.sequence(first, F.least(first + SPAN - 1, F.col("n_rows"))))
    lines = copies(docs, **columns).withColumn("span", spans).withColumn("k", each).drop("span")
    own = share(F.col("n_copies"), F.col("n_rows"), F.col("k"))
    return lines.withColumn("n_copies", own).withColumn("taken", F.col("n_copies") * F.col("size")).drop("n_rows", "k")


def share(n_copies: Column, n_rows: Column, k: Column) -> Column:
    """Copies of the ``k``-th (from 1) of ``n_rows`` rows that share ``n_copies``."""
    return F.floor(n_copies / n_rows) + F.when(k <= n_copies % n_rows, 1).otherwise(0)


def repeat_rows(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0
) -> DataFrame:
    """The mixed corpus: each row of ``docs``, with all its columns as they are, as often as the mix takes it.

    Null sources are a source, null ids an id like others, null texts have no words (see ``copies``). Rows equal in id,
    source and size share their copies as evenly as can be, in the order of their texts' hashes; they are numbered by a
    range sort, so any number of them is spread over tasks. An empty table gives no rows.
    """
    found = copies(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
    key = ("id", "source", "size")
    lines = found.select(F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"), F.col("size").alias("of_size"), "n_rows", "n_copies")
    sized = as_rows(docs, id=named(id_col), source=named(source_col), size=word_count(named(text_col)), mark=F.xxhash64(named(text_col)))

    def same(rows: DataFrame, line: DataFrame) -> Column:
        return rows["id"].eqNullSafe(line["of_id"]) & rows["source"].eqNullSafe(line["of_source"]) & (rows["size"] == line["of_size"])

    every = sized.join(lines.where("n_rows = 1"), same(sized, lines)).select("row", F.col("n_copies").alias("own"))
    if not lines.where("n_rows > 1").isEmpty():  # else the rows are not dealt a second time
        repeated = sized.join(lines.where("n_rows > 1"), same(sized, lines)).select("row", "mark", *key, "n_rows", "n_copies")
        placed = with_places(staged(repeated, "repeated"), [*[F.col(c).asc_nulls_first() for c in key], F.col("mark").asc()], "place")
        starts = placed.groupBy(*[F.col(c).alias(f"of_{c}") for c in key]).agg(F.min("place").alias("start"))
        own = share(F.col("n_copies"), F.col("n_rows"), F.col("place") - F.col("start") + 1)
        every = every.unionByName(placed.join(starts, same(placed, starts)).select("row", own.alias("own")))
    return every.withColumn("k", F.explode(F.array_repeat(F.lit(1), F.col("own").cast("int")))).select("row.*")
