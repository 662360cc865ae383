"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm import (
    conversation_trie,
    filter_audit,
    jaccard,
    language_model,
    mixing,
    packing,
    pii,
    quality_fm,
    quality_rules,
    span_dedup,
    toxicity,
    warc,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents")))


QUALITY_CUT = 0.3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out fifth are never learned from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_fm.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).select(
        "doc_id",
        quality_fm.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


TOXIC_CUT = 0.3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model).select(
        "doc_id",
        quality_fm.held_out(F.col("doc_id")).alias("held_out"),
        "severity",
        "grade",
        "toxic_probability",
        (F.col("toxic_probability") >= TOXIC_CUT).cast("int").alias("toxic"),
    )


TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """Where an executor has the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 4096."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path)


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return winnowing.compare_neighbours(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to bundles, and what the bundles hold when read back."""
    index = warc.archive(spark, _table(spark, sf_dir, "pages"))
    return warc.summary(warc.read_bundles(index))


def op7_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the passages that an earlier one has."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.remove_repeats(docs)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources takes."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the fixed limits, and outliers per language and source."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by their five-word shingles."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove per language in every order, and what they would cost."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations."""
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by word frequency and by the language model."""
    return language_model.score(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_pii": op1_pii,
        "op2_quality": op2_quality,
        "op3_toxicity": op3_toxicity,
        "op4_packing": op4_packing,
        "op5_winnowing": op5_winnowing,
        "op6_warc": op6_warc,
        "op7_span_dedup": op7_span_dedup,
        "op8_mixing": op8_mixing,
        "op9_rules": op9_rules,
        "op10_jaccard": op10_jaccard,
        "op11_filter_audit": op11_filter_audit,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_language_model": op13_language_model,
    }


OP6_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html,
           CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


OP11_SQL = r"""
WITH labelled AS (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
    FROM labels GROUP BY doc_id
), t AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
    FROM documents
), m AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CAST(len(words) < 200 AS INT)
           + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
           + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
           + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
           + 16 * CAST(coalesce(t.doc_id > first, false) AS INT) AS mask
    FROM t LEFT JOIN labelled USING (doc_id)
), counts AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)
), orders AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM orders, (SELECT unnest(range(1, 6))::INT AS step)
)
SELECT part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit > 0), 0) AS BIGINT) AS shapley
FROM counts, steps
GROUP BY part, filter_order, step
"""


# The checksum is worked out bit by bit from its polynomial.
OP12_SQL = r"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (
               PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
           ) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
               lambda crc, b: list_reduce(
                   list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda x, i: xor(x >> 1, 3988292384 * (x & 1))
               )
           ), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
    SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos <= h
    UNION ALL
    SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
), p AS (
    SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           string_agg(md5(role) || md5(text), '') OVER w AS path
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM c
), ends AS (
    SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path
), n AS (
    SELECT path, depth, left(path, 64 * (depth - 1)::BIGINT) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(words) AS words
    FROM p GROUP BY path, depth
), k AS (
    SELECT up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up
), below AS (
    SELECT a.path, sum(CAST(k.n_children IS NULL AS INT)) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
    FROM n a JOIN n b ON starts_with(b.path, a.path) LEFT JOIN k ON k.up = b.path
    GROUP BY a.path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, CASE WHEN n.depth > 0 THEN m.conv_id END AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN below USING (path) LEFT JOIN k ON k.up = n.path LEFT JOIN ends ON ends.path = n.path
LEFT JOIN n m ON m.path = n.up AND n.depth > 0
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": OP6_SQL, "op11_filter_audit": OP11_SQL, "op12_conversation_trie": OP12_SQL}
