"""Vector codes against plain distances, row by row."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

from kpiloom.llm import queries, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, part string, error string, `a.b` int"


def plain(rows, parts, entries, rounds, scale):
    """Codes, errors and codebooks of (vec_id, vector, label) by comparing every part with every entry."""
    kept = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    bounds = [p * len(kept[0][1]) // parts for p in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(bounds, bounds[1:])] for _, v, _ in kept]
    books = [[own[p] for own in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for own in cut:
            for p in range(parts):
                groups[p, nearest(p, own[p])[1]].append(own[p])
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    out, by_label = [], defaultdict(int)
    for (i, _, label), own in zip(kept, cut):
        found = [nearest(p, own[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, code, error, by_label[label]) for i, code, error, label in out], hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA).repartition(3)
    coded, books = vectorcodes.compress(df, **settings)
    own = vectorcodes.with_label_error(coded).collect()
    return [(r.id, r.code, r.error, r.label_error) for r in own], books.sha256() if books else ""


def vectors(rng, n, dims, spread=1.0):
    return [(i, [rng.choice([-1, 1]) * rng.random() * spread for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n, dims, parts, entries, rounds", [(200, 16, 4, 8, 2), (40, 10, 4, 64, 1), (30, 6, 6, 5, 0), (9, 3, 16, 4, 2)])
def test_against_plain_distances(spark, n, dims, parts, entries, rounds):
    rows = vectors(random.Random(n), n, dims)
    settings = {"parts": parts, "entries": entries, "rounds": rounds, "scale": 16}
    got, book = run(spark, rows, **settings)
    expected, own = plain(rows, **settings)
    assert sorted(got) == sorted(expected) and book == own


def test_nulls_ties_copies_and_other_lengths(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(4)], 7) for i in range(60)]
    rows += rows[:20] * 2 + [(None, [1.0, 1.0, 1.0, 1.0], None)] * 3
    rows += [(70, None, 1), (71, [1.0, None, 0.0, 0.0], 1), (72, [math.nan] * 4, 1), (73, [math.inf, 0.0, 0.0, 0.0], 1)]
    rows += [(74, [1.0, 2.0], 1), (75, [], 1)]
    settings = {"parts": 2, "entries": 6, "rounds": 2, "scale": 1}
    got, book = run(spark, rows, **settings)
    expected, own = plain(rows, **settings)
    assert sorted(got, key=str) == sorted(expected, key=str) and book == own


def test_empty_and_too_large(spark):
    assert run(spark, []) == ([], "")
    assert run(spark, [(1, None, 1), (2, [1e30] * 16, 1)]) == ([], "")
    got, _ = run(spark, [(1, [], 1), (2, [], 1)])
    assert sorted(got) == [(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)]


def test_more_than_256_entries(spark):
    rows = [(i, [float(i)], None) for i in range(300)]
    got, _ = run(spark, rows, parts=1, entries=300, rounds=1, scale=1)
    assert sorted(got) == [(i, f"{i:04x}", 0, 0) for i in range(300)]


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    expected, book = plain([(r.vec_id, r.embedding, r.label) for r in rows], 16, 64, 2, 256)
    got = queries.op12_vector_codes(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted((*r, book) for r in expected)
