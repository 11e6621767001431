"""Near duplicates, components, top-k, mixing, archives and the pipeline against plain versions."""

import gzip
import hashlib
import io
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from kpiloom.llm import graph, mixing, pii, quality, queries, simhash, topk, warc
from kpiloom.llm.common import staged

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, linked):
    """Smallest key reachable, by key, over all pairs."""
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                a1, b1 = top(a), top(b)
                root[max(a1, b1)] = min(a1, b1)
    return {k: top(k) for k in keys}


def near(a, b):
    return (a ^ b).bit_count() <= 3


@pytest.mark.parametrize("cell_rows", [2048, 3])
def test_near_duplicates(documents, corpus, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    marks = {i: plain_fingerprint(t) for i, t, *_ in corpus}
    least = defaultdict(lambda: 1 << 60)
    roots = plain_components(sorted(set(marks.values())), near)
    for i, mark in marks.items():
        least[roots[mark]] = min(least[roots[mark]], i)
    rows = simhash.near_duplicates(documents).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{m:016x}", least[roots[m]]) for i, m in marks.items()}
    kept = simhash.keep_one(documents)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values())) and kept.columns == documents.columns


@pytest.mark.parametrize("cell_rows", [2048, 4])
def test_links_of_planted_fingerprints(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    rng = random.Random(3)
    marks = set()
    for _ in range(25):
        mark = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            marks.add(mark)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                mark ^= 1 << bit
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    found = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long")).collect()
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in found}
    assert all(near(a, b) for a, b in pairs)
    pairs |= {(b, a) for a, b in pairs}
    assert plain_components(sorted(marks), near) == plain_components(sorted(marks), lambda a, b: (a, b) in pairs)


@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=2))
def test_counts_bound_the_distance(pair):
    a, b = np.array(pair, np.uint64)
    count = lambda x: ((x | x >> np.uint64(1)) & simhash.EVEN) | ((x & x << np.uint64(1)) & simhash.ODD)
    apart = sum(abs((int(a) >> s & 3).bit_count() - (int(b) >> s & 3).bit_count()) for s in range(0, 64, 2))
    assert int(np.bitwise_count(count(a) ^ count(b))) == apart <= int(np.bitwise_count(a ^ b))


def test_a_dense_group_has_few_links():
    centre = random.Random(1).getrandbits(63)
    marks = np.array([centre ^ (1 << b) for b in range(60)], np.int64)
    assert len(simhash.spanning_links(marks, np.ones(60, bool), 3)) == 59
    first = np.arange(60) == 0
    assert len(simhash.spanning_links(marks, first, 3)) == 59 and simhash.spanning_links(marks, first & ~first, 3) == []


def test_near_duplicates_edge_cases(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {5}
    assert simhash.keep_one(odd).columns == odd.columns
    assert simhash.keep_one(odd).count() == len({r.fingerprint for r in rows})
    assert simhash.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(90)]
    edges += [(7, 7), (1, 0), (-5, 300)]
    linked = {(min(e), max(e)) for e in edges}
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == plain_components(nodes, lambda a, b: (a, b) in linked) and len(rows) == len(nodes)


def plain_search(rows, every, k):
    ints = {}
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ints[i] = (vec_id, [int(np.floor(64 * x)) for x in v])
    out = set()
    for vec_id, q in {(a, tuple(b)) for a, b in ints.values() if a % every == 0}:
        scores = sorted((-sum(x * y for x, y in zip(q, v)), other) for other, v in ints.values() if other != vec_id)[:k]
        out |= {(vec_id, rank, other, -s) for rank, (s, other) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("block, steps, alone, sample", [(8192, 16, 0.25, 4096), (40, 3, 0.9, 0), (40, 50, 0.0, 30), (300, 1, 0.5, 7)])
def test_search(spark, monkeypatch, block, steps, alone, sample):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "STEPS", steps)
    monkeypatch.setattr(topk, "ALONE", alone)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(topk, "FEW", 1)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(200)]
    rows += [(1000 + i, rows[20][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2001, [0.1, None]), (2002, [float("nan")] * 6), (2003, [float("inf"), 1.0]), (2004, []), (None, [1.0] * 6)]
    rows += [(2005, [0.5, -0.5]), (3, [0.25] * 6), (3, [0.25] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.search(df, every=20, k=5).collect()} == plain_search(rows, 20, 5)
    assert topk.search(df.limit(0), every=20, k=5).count() == 0


def test_reading_stops_before_the_end_and_resolves_few(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(0, 0.12, (4000, 32))).astype(np.float32)
    stops = []
    own = topk.resolved
    monkeypatch.setattr(topk, "resolved", lambda lists, ids, q, rows, k, step: stops.append((step, len(rows))) or own(lists, ids, q, rows, k, step))
    ids, q_ids = np.arange(4000), np.arange(0, 4000, 100)
    scores = x[q_ids] @ x[:800].T
    scores[q_ids[:, None] == ids[None, :800]] = -np.inf
    known = topk.kth_best(scores, 10)
    found = list(topk.best(topk.Lists(x), ids, x[q_ids], q_ids, 10, known))
    assert len(stops) == len(q_ids) and all(step < topk.STEPS and n <= topk.FEW * 10 for step, n in stops)
    for i, q in enumerate(q_ids):
        every = sorted((-float(x[q] @ x[r]), r) for r in range(4000) if r != q)[:10]
        assert [(r, s) for j, r, s in found if j == i] == [(r, int(-s)) for s, r in every]
    none = list(topk.best(topk.Lists(x), ids, x[q_ids], q_ids, 10, np.full(len(q_ids), 10**7)))
    assert none == [] and len(stops) == len(q_ids)  # a block that cannot reach what is known is not read


def test_search_with_few_rows_and_large_numbers(spark):
    rows = [(i, [1e7 * i, -2e7]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.search(df, every=2, k=20).collect()} == plain_search(rows, 2, 20)


def plain_targets(sizes):
    """By source: the words it is due."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, due, free = sum(sizes.values()), {}, list(names)
    while True:
        level = (total - sum(due.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return due | {s: level * weight[s] for s in free}
        due |= {s: 3 * sizes[s] for s in over}
        free = [s for s in free if s not in over]


def test_mix(documents, corpus):
    sizes, own = defaultdict(int), {}
    for i, text, _, source, _ in corpus:
        own[i] = (source, len(WORDS.findall(text)))
        sizes[source] += own[i][1]
    rows = mixing.mix(documents).collect()
    due, taken = plain_targets(sizes), defaultdict(int)
    largest = defaultdict(int)
    for r in rows:
        assert (r.source, r.size) == own[r.doc_id] and r.taken == r.size * r.n_copies <= 3 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(due[r.source])
        rate = due[r.source] / sizes[r.source]
        assert r.size == 0 or int(rate) <= r.n_copies <= int(rate) + 1
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(rows) == len(corpus)
    assert all(abs(taken[s] - due[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(documents.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}
    repeated = mixing.repeat_rows(documents)
    assert repeated.columns == documents.columns
    assert {(r.doc_id, r["count"]) for r in repeated.groupBy("doc_id").count().collect()} == {(r.doc_id, r.n_copies) for r in rows if r.n_copies}
    assert not re.search("Python|Arrow|Pandas", mixing.mix(documents)._jdf.queryExecution().toString())


def test_sources_stay_within_a_hundredth_of_their_targets(spark):
    rng = random.Random(8)
    rows = [(i, "w " * int(2 ** rng.uniform(0, 12)), "abc"[i % 3]) for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    due, taken = {r.source: r.target for r in out}, defaultdict(int)
    for r in out:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - due[s]) <= 0.01 * due[s] for s in due)


def test_many_sources(spark):
    rows = [(i, "w " * (i % 9), f"host{i % 400:03}") for i in range(2000)]
    sizes = defaultdict(int)
    for i, text, source in rows:
        sizes[source] += i % 9
    found = mixing.targets(spark.createDataFrame([(s, len(WORDS.findall(t))) for _, t, s in rows], "source string, size long")).collect()
    due = plain_targets(sizes)
    assert {r.source: r.target for r in found} == pytest.approx(due)


NAMES = ("__row", "__fp", "__words", "__id", "__k", "__own", "__source", "__copies", "__Size", "row", "ROW_ID", "a.b", "text.x", "size", "Mark", "place", "k", "own", "of_id", "start")


@pytest.fixture(scope="module")
def clashing(documents):
    """The corpus with columns named like helpers, dotted and in mixed case, each with values of its own."""
    from pyspark.sql import functions as F

    return documents.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


@pytest.mark.parametrize("stage", [
    quality.keep, pii.mask, simhash.keep_one, mixing.repeat_rows,
], ids=lambda f: f.__name__)
def test_stages_keep_every_column(clashing, documents, stage):
    out, plain = stage(clashing), stage(documents)
    assert out.schema.names == clashing.columns
    rows = out.collect()
    own = documents.columns
    order = lambda rows: sorted((tuple(r)[: len(own)] for r in rows), key=repr)
    assert order(rows) == order(plain.collect())
    for r in rows:
        assert list(r[len(own) :]) == [f"{n}-{r.doc_id}" for n in NAMES]


def test_pipeline_keeps_every_column(spark, clashing):
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, ""), name)
        assert docs.schema.names == clashing.columns
    rows = docs.collect()
    assert rows and all(list(r[5:]) == [f"{n}-{r.doc_id}" for n in NAMES] for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= len(rows)


def test_many_equal_rows_share_copies(spark):
    rows = [(None, f"w{i % 3} " * 4, "s") for i in range(300)] + [(i, "w " * 50, "t") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = {(r.doc_id, r.n_copies) for r in mixing.mix(df).collect() if r.doc_id is None}
    assert max(n for _, n in lines) - min(n for _, n in lines) <= 1
    assert mixing.repeat_rows(df).where("doc_id is null").count() == sum(r.n_copies for r in mixing.mix(df).collect() if r.doc_id is None)


def test_rounding_keeps_expectations(spark):
    rows = [(i, "w " * (1 + i % 7), "b" if i % 3 else "a") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    share = mixing.mix(df, seed=0).select("target", "source_size", "source").distinct().collect()
    rate = {r.source: r.target / r.source_size for r in share}
    mean = defaultdict(float)
    for seed in range(12):
        for r in mixing.mix(df, seed=seed).collect():
            mean[r.source] += r.n_copies / 12 / (30 if r.source == "a" else 60)
    assert all(abs(mean[s] - rate[s]) < 0.12 for s in rate)


def test_mix_edge_cases(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 3 * r.size for r in rows)
    copies = [r.n_copies for r in rows if r.doc_id == 5 and r.size == 160]
    assert len(copies) == 4 and max(copies) - min(copies) <= 1
    repeated = mixing.repeat_rows(odd)
    assert repeated.columns == odd.columns and repeated.count() == sum(r.n_copies for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.repeat_rows(empty).count() == 0


def test_archives(spark, tmp_path):
    page = "<p>é</p>" * 40
    rows = [(4, "http://a/1", page), (2, "http://a/2", page), (9, None, page), (5, "u\r\nv", "x"), (6, "u", "x"), (7, "u", None)]
    rows += [(8, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 9), (None, "u", page), (None, "u", "own page " * 30), (2, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS first", "2 AS digest")
    files, path = warc.write_archives(df.repartition(2))
    index = warc.normalise(files, path)
    read = warc.read_records(index, path).select("*", warc.page_of("record_id", "long").alias("page_id"), warc.page_of("refers_to", "long").alias("first"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.first) for r in read.collect()), key=repr)
    expected = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        again = html == page and page_id != 2
        expected.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert got == sorted(expected, key=repr)
    for r in index.collect():  # every record is a gzip member of its own
        with open(f"{path.removeprefix('file://')}/records/{r.file}", "rb") as f:
            f.seek(r.offset)
            assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\nWARC-Type: ")
    none, where = warc.write_archives(df.limit(0))
    assert warc.read_records(warc.normalise(none, where), where).count() == 0


@given(st.lists(st.binary(max_size=300), max_size=5), st.booleans())
@settings(max_examples=100, deadline=None)
def test_records_of_streams(payloads, members):
    whole = [warc.record(i, None, p, "d") for i, p in enumerate(payloads)]
    stream = b"".join(map(gzip.compress, whole)) if members else gzip.compress(b"".join(whole))
    assert [w for _, w in warc.records(warc.inflated(io.BytesIO(stream)))] == whole


def test_pipeline(spark, documents, corpus, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "pii", "mixing", "packing"]
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: t for i, t, *_ in corpus}
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == documents.columns
        seen.append([r.asDict() for r in docs.collect()])
    good = {i for i, t in texts.items() if plain_keep(t)}
    assert {r["doc_id"] for r in seen[0]} == good
    marks = {i: plain_fingerprint(texts[i]) for i in good}
    roots = plain_components(sorted(set(marks.values())), near)
    least = {}
    for i in sorted(good):
        least.setdefault(roots[marks[i]], i)
    assert sorted(r["doc_id"] for r in seen[1]) == sorted(least.values())
    masked = {i: plain_mask(texts[i]) for i in least.values()}
    assert any(masked[i] != texts[i] for i in masked)
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in seen[2]} == {(i, m, len(m)) for i, m in masked.items()}
    copies = {r.doc_id: r.n_copies for r in mixing.mix(spark.createDataFrame(seen[2], documents.schema)).collect()}
    times = defaultdict(int)
    for r in seen[3]:
        assert r["text"] == masked[r["doc_id"]]
        times[r["doc_id"]] += 1
    assert dict(times) == {i: n for i, n in copies.items() if n}
    sizes = defaultdict(int)
    for r in seen[2]:
        sizes[r["source"]] += len(WORDS.findall(r["text"]))
    due, taken, largest = plain_targets(sizes), defaultdict(int), defaultdict(int)
    for r in seen[3]:
        taken[r["source"]] += len(WORDS.findall(r["text"]))
    for r in seen[2]:
        largest[r["source"]] = max(largest[r["source"]], len(WORDS.findall(r["text"])))
    assert all(abs(taken[s] - due[s]) <= largest[s] / 2 + 1e-6 for s in due)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert r.offset + r.length <= 2048
        pieces[r.doc_id, r.sequence_id, r.start].append(np.frombuffer(r.ids, "<u4").tolist())
    for i, n in times.items():
        ids = [*library.encode(masked[i], add_special_tokens=False).ids, 1]
        got = sorted((start, x) for (doc, _, start), own in pieces.items() if doc == i for x in own)
        assert sum((x for _, x in got), []) == sum((ids[a : a + 2048] for a in range(0, len(ids), 2048) for _ in range(n)), [])


def plain_keep(text):
    words = WORDS.findall(text)
    runs = defaultdict(list)
    for i in range(len(words) - 7):
        runs[" ".join(words[i : i + 8])].append(i)
    covered = {k for places in runs.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    limit = max(8, quality.MAX_LONGEST_PERCENT * len(words) // 100 + 1)
    long_runs = [" ".join(words[i : i + limit]) for i in range(len(words) - limit + 1)]
    return len(words) >= 20 and 100 * len(covered) <= 30 * len(words) and len(long_runs) == len(set(long_runs))


RULES = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "IP": r"[0-9]+(?:\.[0-9]+){3}",
    "CARD": r"[0-9](?:[ -]?[0-9])+", "PHONE": r"\+[0-9][ ().0-9-]+[0-9]",
}


def plain_mask(text):
    """Base kinds only; the corpus holds no others."""
    spans = []
    for order, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1]))
            good = {
                "EMAIL": True, "IP": kind == "IP" and all(int(p) <= 255 for p in m.group().split(".")),
                "CARD": 14 <= len(digits) <= 19 and total % 10 == 0, "PHONE": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, m.end(), kind))
    out, at = "", 0
    for start, _, end, kind in sorted(spans):
        if start >= at:
            out += text[at:start] + f"<{kind}>"
            at = end
        else:
            at = max(at, end)
    return out + text[at:]


@pytest.mark.parametrize("name", ["op2_topk", "op7_warc", "op8_quality"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    expected = con.execute(queries.SQL[name])
    columns = sorted(c[0] for c in expected.description)
    order = [c[0] for c in expected.description]
    want = sorted((tuple(r[order.index(c)] for c in columns) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, sf_dir).collect()), key=repr)
    assert got == want
