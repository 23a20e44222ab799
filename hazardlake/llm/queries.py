"""Registered queries of the corpus operators, with their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake.llm import (
    bpe_codec, chat_format, divergence, exact_dedup, hard_negatives, language_id, mixing, near_dedup, neighbours,
    secret_scan, sharding, token_counts, warc,
)
from hazardlake.session import prepare

QUERY_EVERY = 100  # vectors whose id this divides are queries

UNIGRAM_FILE = "piece_bpe_32k.model"
BPE_FILE = "byte_bpe_50k.json"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"))
    return chat_format.digests(_table(spark, sf_dir, "conversations").select(test.columns).unionByName(test))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.joined(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.counted(documents, token_counts.pieces_of(tokenizer_file(UNIGRAM_FILE)))
    return counted.select("doc_id", "tokens.n_tokens", "tokens.score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(_table(spark, sf_dir, "documents"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_codec.encoded(documents, tokenizer_file(BPE_FILE), large=()).select("doc_id", "bpe.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identified(documents).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), F.col("language.lang").alias("lang_pred"),
        "language.score", "language.ambiguous")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = warc.archived(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.captures(spark, warc.deduplicated(spark, raw)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, label=moved)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_exact_dedup, op2_chat_format, op3_ngram_join, op4_token_counts, op5_nearest_neighbours, op6_secret_scan,
    op7_bpe_codec, op8_mixing, op9_sharding, op10_language_id, op11_warc, op12_hard_negatives,
    op13_divergence)}

TWINS = {
    "op1_exact_dedup": """
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM normal WINDOW g AS (PARTITION BY t)""",
    "op2_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(15 + length(role) + length(text) + len(regexp_extract_all(text, '### |</turn>')))::BIGINT
                   AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op8_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '')) AS key
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS total,
                   [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, 2.0::DOUBLE * total AS cap,
                   (1.5::DOUBLE * sum(total) OVER () - coalesce(sum(2.0::DOUBLE * total) OVER (
                        ORDER BY 2.0::DOUBLE * total / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY 2.0::DOUBLE * total / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sources),
        targets AS (
            SELECT source, total, CASE WHEN cap / weight <= level THEN cap ELSE weight * (
                       SELECT arg_min(level, cap / weight) FROM ranked WHERE cap / weight > level) END AS target
            FROM ranked),
        placed AS (
            SELECT d.*, t.total, t.target, coalesce(sum(size) OVER (
                       PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                   CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS whole
            FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
        taken AS (
            SELECT *, (whole + CASE WHEN start + size / 2 < target - whole * total THEN 1 ELSE 0 END)::INTEGER AS copies
            FROM placed)
        SELECT doc_id, size, total AS source_size, target, (size * copies)::BIGINT AS taken, copies FROM taken""",
    "op11_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                   coalesce(html, '') AS payload
            FROM pages),
        ranked AS (
            SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS kept
            FROM payloads WINDOW same AS (PARTITION BY payload ORDER BY page_id DESC NULLS LAST))
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND place > 1 THEN kept END AS refers_to
        FROM ranked""",
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS cells
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        scored AS (
            SELECT a.nr AS anchor, a.vec_id AS anchor_id, r.nr, r.vec_id, r.label = a.label AS same,
                   coalesce(list_sum(list_transform(list_zip(a.cells, r.cells), lambda p: p[1] * p[2])), 0)::BIGINT AS score
            FROM usable a JOIN usable r ON r.nr <> a.nr AND len(r.cells) = len(a.cells) WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, nr) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               row_number() OVER (PARTITION BY p.anchor, p.nr ORDER BY n.score DESC, n.vec_id NULLS LAST, n.nr)::INTEGER AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        QUALIFY rank <= 5""",
    "op13_divergence": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        uses AS (SELECT nr, lang, source, unnest(terms) AS term FROM rows),
        kept AS (SELECT lang, term, count(*) AS in_lang FROM uses GROUP BY ALL HAVING count(DISTINCT nr) >= 3),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(in_lang)::HUGEINT AS n FROM kept GROUP BY ALL),
        counted AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM uses SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (
            SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n
            FROM (SELECT DISTINCT lang, source FROM rows) g LEFT JOIN counted USING (lang, source) GROUP BY ALL),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                   1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + l.v) AS p,
                   1 + (1000000000::HUGEINT * (k.in_lang + 1)) // (l.n + l.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counted c USING (lang, source, term)),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item,
                   coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL),
        found AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
