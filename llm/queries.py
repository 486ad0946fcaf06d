"""One query for each operator, over its whole table; SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import codes, decontam, divergence, hilbert, langid, lines, matrices, overlap, packing, quality, simhash, substrings, tokens, warc
from llm.common import cut, table

SEQUENCE = 2048


def ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces of `docs` in sequences of SEQUENCE tokens by minimum bin slack."""
    pieces = cut(tokens.pieces(docs, ranks(), public_tokenizers.PATTERN, SEQUENCE), "pieces")
    counts = packing.length_counts(pieces)
    plan = packing.minimum_slack(counts, SEQUENCE)
    packing.check_plan(plan, counts, SEQUENCE)
    placed = packing.place(pieces, plan)
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores of `docs` by a model fitted on the rated documents among them."""
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.score(docs, quality.train(docs, ratings))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(spark, table(spark, sf_dir, "documents"), sf_dir)
    return scored.select("doc_id", "expected_grade", "p_top", "keep")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    return langid.identify(docs.select("doc_id", "text", "held_out"), langid.learn(docs.filter("not held_out")))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return matrices.written(docs, ranks(), public_tokenizers.PATTERN, SEQUENCE)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "item_id", "lcs_share", "answer_share", "cosine")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"))


def op11_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.similar_sets(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codes.encode(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash, op2_packing, op3_quality, op4_language, op5_lines, op6_warc, op7_token_matrices, op8_decontamination, op9_substrings, op10_neighbours, op11_overlap, op12_divergence, op13_codes)
}

_NEAREST = """
    SELECT x.part, x.row, arg_min(e.entry, {{'d': d, 'e': e.entry}}) AS entry, min(d) AS d
    FROM x JOIN {book} e USING (part), LATERAL (SELECT list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - e.c[i]) * (x.v[i] - e.c[i]))) AS d)
    GROUP BY ALL
"""
_MOVED = """
    SELECT e.part, e.entry, coalesce(m.c, e.c) AS c
    FROM {book} e LEFT JOIN (
        SELECT part, entry, list(CASE WHEN s < 0 THEN -((n - 1 - s) // n) ELSE s // n END ORDER BY pos) AS c
        FROM (
            SELECT part, entry, pos, count(*) AS n, CAST(sum(value) AS BIGINT) AS s
            FROM (SELECT a.part, a.entry, unnest(x.v) AS value, generate_subscripts(x.v, 1) AS pos FROM {codes} a JOIN x USING (part, row))
            GROUP BY ALL
        ) GROUP BY ALL
    ) m USING (part, entry)
"""

ORACLE = {
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), t AS (
            SELECT row, lang, source, unnest(terms) AS term FROM d
        ), kept AS MATERIALIZED (
            SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 30
        ), n AS MATERIALIZED (
            SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
        ), sizes AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), g AS (
            SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM d)
            LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) USING (lang, source)
            LEFT JOIN sizes USING (lang)
        ), p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
                1 + CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 5) // (g.total + 5 * g.v) AS p
            FROM g JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
        ), q AS (
            SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM n GROUP BY ALL) JOIN sizes USING (lang)
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(CAST(s.value AS BIGINT), 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
            ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
            UNION ALL
            SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value,
            CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM found
        QUALIFY part = 'pair' OR rank <= 50
    """,
    "op13_codes": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
                list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * 256) AS BIGINT)) AS whole
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        ), x AS MATERIALIZED (
            SELECT row, part, whole[part * (len(whole) // 16) + 1 : (part + 1) * (len(whole) // 16)] AS v
            FROM kept, range(16) r(part)
        ), book0 AS MATERIALIZED (
            SELECT part, row - 1 AS entry, v AS c FROM x WHERE row <= 64
        ), codes0 AS MATERIALIZED ({_NEAREST.format(book="book0")}
        ), book1 AS MATERIALIZED ({_MOVED.format(book="book0", codes="codes0")}
        ), codes1 AS MATERIALIZED ({_NEAREST.format(book="book1")}
        ), book2 AS MATERIALIZED ({_MOVED.format(book="book1", codes="codes1")}
        ), codes2 AS MATERIALIZED ({_NEAREST.format(book="book2")}
        ), coded AS (
            SELECT row, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM codes2 GROUP BY row
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
        FROM coded JOIN kept USING (row)
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM f
    """,
}
