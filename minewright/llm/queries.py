"""Registered queries of the pipeline operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import chat, exact_dedup, html_extract, jaccard, langid, mixing, negatives, packing, pii, simhash, suffixes, toxicity, variants
from minewright.llm.batches import bounded_batches
from minewright.session import cut

#: The vocabulary of byte_bpe_50k.json as ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents"), n=3, percent=90)


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    made = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"))
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(made)
    return chat.digests(cut(chat.format_chats(turns), "chats"))


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_extract.extracted(pages, html_extract.fit(pages)).drop("n_blocks", "n_kept")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).drop("copies")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), RANKS).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.edited_and_next(_table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return langid.identified(docs, langid.fit(docs))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.graded(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, folder, "documents"))


def op12_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.without_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings").where(negatives.complete("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", label.alias("label"), negatives.integers("embedding").alias("vec")))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_chat, op3_html, op4_mixing, op5_packing, op6_simhash, op7_pii, op8_langid, op9_toxicity,
                                   op10_ngram_jaccard, op11_variants, op12_repeats, op13_negatives)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE_SQL = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    "op10_ngram_jaccard": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
        tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS o
                   FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id
                   AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
        links AS (SELECT x, y FROM shared WHERE 100 * o >= 90 * (nx + ny - o)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(y) FROM reach WHERE reach.x = sets.doc_id) AS component_id FROM sets""",
    "op4_mixing": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   (('0x' || substr(md5('11|' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS words, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w
              FROM d GROUP BY source),
        beginnings AS (
            SELECT *, sum(words) OVER r - words AS s0, sum(w) OVER r - w AS w0, sum(words) OVER () AS sum_s, sum(w) OVER () AS sum_w
            FROM s WINDOW r AS (ORDER BY words / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
        t AS (SELECT source, words, least(w * (SELECT max((sum_s - 3 * s0) / (sum_w - w0)) FROM beginnings), 3 * words)::DOUBLE AS target FROM s),
        aims AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS whole FROM t),
        rests AS (SELECT *, target - whole * words AS rest FROM aims),
        steps AS (SELECT source, floor(log2(size) * 2)::INT AS step, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL),
        least_scales AS (
            SELECT steps.*, (rest - coalesce(sum(steps.words) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(pow(2.0, step / 4) * steps.words) OVER (p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS least_scale
            FROM steps JOIN rests ON steps.source IS NOT DISTINCT FROM rests.source
            WINDOW p AS (PARTITION BY steps.source ORDER BY step DESC)),
        chances AS (SELECT source, step, least(1.0, pow(2.0, step / 4) * max(least_scale) OVER (PARTITION BY source)) AS chance FROM least_scales),
        ranked AS (
            SELECT d.*, CASE WHEN chance > 0 THEN u / (1 - u) * (1 - chance) / chance END AS rank
            FROM d LEFT JOIN chances c ON d.source IS NOT DISTINCT FROM c.source AND d.size > 0 AND floor(log2(d.size) * 2)::INT = c.step),
        placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ranked)
        SELECT doc_id, size::BIGINT AS size, words AS source_size, target,
               ((whole + CASE WHEN rank IS NOT NULL AND 2 * ahead + size <= 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
        FROM placed JOIN rests ON placed.source IS NOT DISTINCT FROM rests.source""",
    "op12_repeats": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        strings AS (SELECT r, unnest(range(0, octet_length(b) - 399)) AS s, unnest([md5(b[s + 1:s + 400]) FOR s IN range(0, octet_length(b) - 399)]) AS m
                    FROM d WHERE octet_length(b) >= 400),
        counted AS (SELECT r, s, count(*) OVER (PARTITION BY m) AS n FROM strings),
        marked AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 400 THEN 0 ELSE 1 END AS begins FROM counted WHERE n > 1),
        numbered AS (SELECT r, s, sum(begins) OVER (PARTITION BY r ORDER BY s) AS span FROM marked),
        spans AS (SELECT r, min(s) AS a, max(s) + 400 AS z FROM numbered GROUP BY r, span),
        gaps AS (SELECT r, coalesce(lag(z) OVER w, 0) AS a, a AS z FROM spans WINDOW w AS (PARTITION BY r ORDER BY a)
                 UNION ALL SELECT r, max(z), 1000000000 FROM spans GROUP BY r),
        rests AS (SELECT r, string_agg(hex(b[a + 1:z]), '' ORDER BY a) AS rest FROM gaps JOIN d USING (r) GROUP BY r),
        totals AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
        SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(coalesce(unhex(rest), b)) AS kept_sha256
        FROM d LEFT JOIN rests USING (r) LEFT JOIN totals USING (r)""",
    "op13_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
                   list_sum([p[1] * p[2] FOR p IN list_zip(a.v, b.v)])::BIGINT AS score
            FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        near AS (SELECT a, b AS p, score AS ps FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
        ranked AS (
            SELECT n.a, p, ps, s.b, s.score, row_number() OVER (PARTITION BY n.a, p ORDER BY s.score DESC, s.b) AS rank
            FROM near n JOIN scored s ON n.a = s.a AND NOT s.same AND 30 * ps <= 100 * s.score AND 100 * s.score <= 90 * ps)
        SELECT a AS anchor_id, p AS positive_id, rank::INT AS rank, b AS negative_id, ps AS positive_score, score AS negative_score
        FROM ranked WHERE rank <= 10""",
}
