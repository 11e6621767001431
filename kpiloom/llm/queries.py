"""The registered queries of this subpackage, each beside its comparison SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import arrowfiles, conversations, licenses, mixing, packing, pii, quality, simhash, suffixdedup, tokencount, topk, vectorcodes, warc
from kpiloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


OP2_SQL = """
WITH r AS (
    SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), v AS (
    SELECT vec_id, list(CAST(floor(64 * x) AS DOUBLE) ORDER BY d) AS v FROM r GROUP BY vec_id
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM k WHERE r <= 20
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "n_copies")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.find_licences(docs, licenses.train(docs))
    return found.select("doc_id", "paragraph", "family", F.round("similarity", 6).alias("similarity"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(pii.of_kinds(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    base = F.sha2(pii.listed(pii.of_kinds(F.col("spans"), *pii.BASE)), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    files, path = warc.write_archives(pages)
    read = warc.read_records(warc.normalise(files, path), path)
    kind = pages.schema["page_id"].dataType.simpleString()
    return read.select(
        warc.page_of("record_id", kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to", kind).alias("refers_to"),
    )


OP7_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(table(spark, sf_dir, "documents"))
    return found.drop("longest_repeat")


# The longest repeat is within its limit where no run of one word more than the limit (of 8 at least) occurs twice.
OP8_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), n AS (
    SELECT *, len(words) AS n_words, greatest(8, {quality.MAX_LONGEST_PERCENT} * len(words) // 100 + 1) AS too_long,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM d
), places AS (SELECT r, n_words, too_long, words, unnest(range(1, n_words - 6)) AS i FROM n),
runs AS (SELECT r, i, array_to_string(words[i : i + 7], ' ') AS run FROM places),
again AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, run) > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM again) GROUP BY r),
long_runs AS (
    SELECT r, array_to_string(words[i : i + too_long - 1], ' ') AS run FROM places
    WHERE i <= n_words - too_long + 1 AND r IN (SELECT r FROM again)
), too_long AS (SELECT r FROM long_runs GROUP BY r HAVING count(*) > count(DISTINCT run)),
counted AS (
    SELECT n.r, doc_id, n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
    FROM n LEFT JOIN covered ON covered.r = n.r
), judged AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_COVERED_PERCENT} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM too_long) AS kept
FROM judged
"""


def op9_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = arrowfiles.write_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return arrowfiles.read_checksums(spark, path)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, by a checksum of id and turn; nulls are one space."""
    id_turn = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    by = F.crc32(F.concat(id_turn[0], F.lit(":"), id_turn[1]).cast("binary")) % 20
    new_text = F.when(by == 1, "").when(by == 2, F.translate(text, ".!?", "")).otherwise(text)
    made = rows.where(by != 0).select(
        "conv_id", "turn", F.when(by == 4, "user").otherwise(role).alias("role"), new_text.alias("text"), by.alias("by")
    )
    return made.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("by") == 3, 2).otherwise(1)))).drop("by", "copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(damaged(given))
    parts = given.select(F.col("conv_id").alias("id")).distinct()
    for part in (repaired.faults, conversations.digests(repaired.edits)):
        parts = parts.unionByName(part, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = parts.groupBy("id").agg(*[F.max(c).alias(c) for c in (*counts, "audit", "repaired_sha256")])
    return whole.select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# States: 0 nothing yet, 1 after a system turn, 2 after user, 3 after assistant. ``ins``: up to three turns put in before one.
OP11_SQL = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), n)) AS t
), g AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id_turn
    FROM conversations
), b AS (
    SELECT *, xor(list_reduce(
        list_transform(range(1, length(id_turn) + 1), lambda i: CAST(ascii(id_turn[i]) AS BIGINT)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295
    ), 4294967295) % 20 AS spot
    FROM g, crc
), d AS (
    SELECT conv_id, turn, CASE WHEN spot = 4 THEN 'user' ELSE role END AS role,
           CASE spot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN spot = 3 THEN 2 ELSE 1 END)) AS copy
    FROM b WHERE spot <> 0
), o AS (
    SELECT *, left(role, 1) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_letter
    FROM d
), f AS (
    SELECT *, last_letter = '' AS blank,
           last_letter <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           lag(k) OVER (PARTITION BY conv_id ORDER BY i) || k AS pair
    FROM o
), t AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND last_letter NOT IN ('.', '!', '?') AS late FROM f),
ins AS (
    SELECT * FROM (VALUES
        (0, 0, 0, '', ''), (1, 0, 1, '', ''), (2, 0, 2, '', ''), (3, 0, 3, '', ''),
        (0, 2, 2, 'I', 'u'), (1, 2, 2, 'I', 'u'), (2, 2, 3, 'I', 'a'), (3, 2, 2, 'I', 'u'),
        (0, 4, 3, 'II', 'ua'), (1, 4, 3, 'II', 'ua'), (2, 4, 2, 'II', 'au'), (3, 4, 3, 'II', 'ua'),
        (0, 6, 2, 'III', 'uau'), (1, 6, 2, 'III', 'uau'), (2, 6, 3, 'III', 'aua'), (3, 6, 2, 'III', 'uau')
    ) AS v(source, price, st, letters, added)
), way AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, 0 AS cost, '' AS audit, '' AS lines FROM t
    UNION ALL
    SELECT conv_id, i, st, cost, audit, lines FROM (
        SELECT way.conv_id, t.i, CASE WHEN e = 'D' THEN ins.st WHEN e = 'K' AND k = 's' THEN 1 WHEN ins.st = 2 THEN 3 ELSE 2 END AS st,
               cost + price + CASE e WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN late AND e <> 'D' THEN 1 ELSE 0 END AS cost,
               audit || letters || e AS audit,
               lines || replace(replace(added, 'u', 'user:' || chr(10)), 'a', 'assistant:' || chr(10)) || CASE e
                   WHEN 'D' THEN ''
                   WHEN 'K' THEN role || ':' || text || chr(10)
                   ELSE CASE WHEN ins.st = 2 THEN 'assistant:' ELSE 'user:' END || text || chr(10)
               END AS lines
        FROM way
        JOIN t ON way.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = way.i + 1
        JOIN ins ON ins.source = way.st
        JOIN (VALUES ('D'), ('R'), ('K')) AS edits(e) ON e = 'D' OR NOT gone AND (
            e = 'R' OR k = 's' AND ins.st = 0 OR k = 'u' AND ins.st <> 2 OR k = 'a' AND ins.st = 2
        )
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1
), ended AS (
    SELECT conv_id, cost + price AS cost, audit || letters AS audit,
           lines || replace(replace(added, 'u', 'user:' || chr(10)), 'a', 'assistant:' || chr(10)) AS lines
    FROM (SELECT * FROM way QUALIFY i = max(i) OVER (PARTITION BY conv_id)) AS w JOIN ins ON ins.source = w.st
    WHERE ins.st = 3 OR ins.st = 0
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost + price, audit || letters) = 1
), counted AS (
    SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (late) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM t GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(left(lines, length(lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN counted ON ids.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN ended ON ids.conv_id IS NOT DISTINCT FROM ended.conv_id
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return vectorcodes.with_label_error(rows).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    )


def op12_sql(rounds: int = 2) -> str:
    """Books c0 (the smallest ids), c1 and c2, with the nearest entries a0, a1 and a2 of all parts."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
    SELECT n, p, min(least) AS least, min(e) AS e FROM (
        SELECT n, parts.p, e, dist AS least FROM (
            SELECT n, parts.p, e, list_sum(list_transform(range(1, len(v) + 1), lambda j: (v[j] - w[j]) * (v[j] - w[j]))) AS dist
            FROM parts JOIN c{i} ON parts.p = c{i}.p
        ) AS parts QUALIFY rank() OVER (PARTITION BY n, parts.p ORDER BY dist) = 1
    ) GROUP BY n, p
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
    SELECT p, e, list(m ORDER BY j) AS w FROM (
        SELECT p, e, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS m
        FROM (SELECT a{i}.p, a{i}.e, v, unnest(range(1, len(v) + 1)) AS j FROM a{i} JOIN parts ON a{i}.n = parts.n AND a{i}.p = parts.p)
        GROUP BY p, e, j
    ) GROUP BY p, e
), c{i + 1} AS (SELECT c{i}.p, c{i}.e, coalesce(m{i}.w, c{i}.w) AS w FROM c{i} LEFT JOIN m{i} ON c{i}.p = m{i}.p AND c{i}.e = m{i}.e)""")
    return f"""
WITH x AS (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), k AS (SELECT *, row_number() OVER (ORDER BY vec_id, v) AS n, len(v) // 16 AS size FROM x),
parts AS (SELECT n, p, v[p * size + 1 : (p + 1) * size] AS v FROM k, range(16) AS t(p)),
c0 AS (SELECT p, n - 1 AS e, v AS w FROM parts WHERE n <= 64),
{", ".join(steps)},
book AS (
    SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}
), done AS (
    SELECT n, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, sum(least) AS error FROM a{rounds} GROUP BY n
)
SELECT vec_id, lower(code) AS code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN done USING (n), book
"""


def op13_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_topk": op2_topk,
    "op3_mixing": op3_mixing,
    "op4_licenses": op4_licenses,
    "op5_pii": op5_pii,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_arrow_files": op9_arrow_files,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_count": op13_token_count,
}

SQL: dict[str, str] = {"op2_topk": OP2_SQL, "op7_warc": OP7_SQL, "op8_quality": OP8_SQL, "op11_conversation_repair": OP11_SQL, "op12_vector_codes": op12_sql()}
