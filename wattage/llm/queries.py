"""Registered queries of the corpus operators: thin, one per operator, whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .common import table
from .decontaminate import find_contamination
from .html_text import extract_text
from .merkle import fold, merkle_manifest, siblings, tampered_leaf
from .neardup import near_duplicates
from .packing import pack
from .secrets import find_secrets, spans_text
from .simhash import simhash_groups
from .token_counts import length_histogram, totals_by_limit
from .token_files import token_files
from .topk import quantised, top_k
from .toxicity import labelled_sample, learn_lexicon, score_toxicity
from .warc import archive_pages

#: A document at or above this score is toxic.
TOXIC = 0.7


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from; a null id, which no label names, is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn_lexicon(labelled_sample(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"))))
    rows = score_toxicity(docs, lexicon)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_secrets(table(spark, sf_dir, "documents"), reach=None)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"),
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"), scale=64, one_per_id=False)
    return top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), end_id=0, context=2048)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals_by_limit(length_histogram(table(spark, sf_dir, "documents")))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive_pages(table(spark, sf_dir, "pages"), least_bytes=0)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), k=4, threshold=80)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_files(table(spark, sf_dir, "documents"), end_id=2)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("_tampered", tampered_leaf(docs))
    rows = merkle_manifest(docs, fanout=2, carry=["_tampered"])
    folded = fold(F.col("path"), F.coalesce("_tampered", "leaf"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), k=3, most=3).select("doc_id", "fingerprint", "component_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))[0]


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_html_text": op5_html_text,
    "op6_token_counts": op6_token_counts,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_token_files": op10_token_files,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash": op12_simhash,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB text for the operators that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op3_exact_top_k": """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
), r AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY s.r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op9_decontamination": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
    FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM bw
), dw AS (
    SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), m AS (
    SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n
), h AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id
), i AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
    FROM m GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
""",
    # crc32 is not a DuckDB function: eight shifts for each digit of the id.
    "op11_merkle_manifest": """
WITH RECURSIVE d AS (
    SELECT doc_id, lang, n_chars,
        (SELECT list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
        coalesce(strlen(text) || ':' || text, '-') AS after
    FROM documents
), l AS (
    SELECT doc_id, lang, sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || after) AS leaf,
        sha256(before || coalesce(strlen(c) || ':' || c, '-') || after) AS used
    FROM (SELECT *, (CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END)::VARCHAR AS c FROM d)
), leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM l
), nodes AS (
    SELECT g, n, 0 AS lev, pos, leaf AS h FROM leaves
    UNION ALL
    SELECT g, n, lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE (1::BIGINT << lev) < n GROUP BY g, n, lev, pos // 2
), subs AS (
    SELECT g AS pos, h, count(*) OVER () AS n FROM nodes WHERE (1::BIGINT << lev) >= n
), upper AS (
    SELECT n, 0 AS lev, pos, h FROM subs
    UNION ALL
    SELECT n, lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE (1::BIGINT << lev) < n GROUP BY n, lev, pos // 2
), top AS (
    SELECT h AS root FROM upper WHERE (1::BIGINT << lev) >= n
), steps AS (
    SELECT l.g, l.pos, lev AS step, (l.pos >> lev) % 2 AS odd, s.h
    FROM (SELECT g, pos, unnest(range(40)) AS lev, n FROM leaves) l LEFT JOIN nodes s USING (g, lev)
    WHERE (1::BIGINT << lev) < l.n AND s.pos = xor(l.pos >> lev, 1)
    UNION ALL
    SELECT l.g, l.pos, 64 + lev, (l.g >> lev) % 2, s.h
    FROM (SELECT g, pos, unnest(range(40)) AS lev FROM leaves) l JOIN upper s USING (lev)
    WHERE (1::BIGINT << lev) < s.n AND s.pos = xor(l.g >> lev, 1)
), proofs AS (
    SELECT g, pos, string_agg(h, '' ORDER BY step) AS proof FROM steps GROUP BY g, pos
), levels AS (
    SELECT g, n, lev AS step, row_number() OVER (PARTITION BY g ORDER BY lev) AS i FROM (
        SELECT DISTINCT g, n, unnest(range(40)) AS lev FROM leaves
        UNION ALL
        SELECT DISTINCT g, (SELECT count(*) FROM subs), 64 + unnest(range(40)) FROM leaves
    ) WHERE (1::BIGINT << (lev % 64)) < n
), folded AS (
    SELECT g, pos, used AS h, 0 AS i FROM leaves
    UNION ALL
    SELECT f.g, f.pos, sha256(CASE WHEN s.odd = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), v.i
    FROM folded f JOIN levels v ON v.g = f.g AND v.i = f.i + 1 LEFT JOIN steps s ON s.g = f.g AND s.pos = f.pos AND s.step = v.step
), ends AS (
    SELECT g, pos, arg_max(h, i) AS folded_root FROM folded GROUP BY g, pos
)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subs s ON s.pos = leaves.g CROSS JOIN top JOIN ends ON ends.g = leaves.g AND ends.pos = leaves.pos
    LEFT JOIN proofs ON proofs.g = leaves.g AND proofs.pos = leaves.pos
""",
}
