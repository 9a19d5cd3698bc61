"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm.chat import format_conversations, format_digest, text_parts
from pairmill.llm.divergence import source_divergence
from pairmill.llm.hard_negatives import hard_negatives
from pairmill.llm.jaccard import jaccard_components
from pairmill.llm.language_model import language_model_scores
from pairmill.llm.near_vectors import near_vectors
from pairmill.llm.packing import best_fit_packing
from pairmill.llm.quality import quality_scores
from pairmill.llm.repetition import repetition_quality
from pairmill.llm.templates import contaminated
from pairmill.llm.token_counts import token_counts
from pairmill.llm.toxicity import toxicity_scores
from pairmill.llm.training_order import training_order

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


# Fixed value: the conversation that every run of op 1 adds.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query
def op1_chat_format(spark, sf_dir):
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = turns.unionByName(added).withColumn("parts", text_parts(F.col("text")))
    return format_digest(format_conversations(messages))


_TURNS = f"""
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
"""

ORACLE["op1_chat_format"] = f"""
WITH turns AS (
    SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS shown FROM ({_TURNS})
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, shown))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, shown)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(role) + length(shown) + 24)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op2_language_model(spark, sf_dir):
    return language_model_scores(table(spark, sf_dir, "documents"))


@query
def op3_training_order(spark, sf_dir):
    return training_order(table(spark, sf_dir, "documents"), vocabulary_path(), key=20_240_229)


@query
def op4_repetition_quality(spark, sf_dir):
    return repetition_quality(table(spark, sf_dir, "documents"))


ORACLE["op4_repetition_quality"] = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
flat AS (SELECT doc_id, unnest(range(len(w))) AS place, length(unnest(w)) AS size FROM words),
lengths(n) AS (VALUES (3), (5), (6), (7), (8), (9), (10)),
begins AS (
    SELECT doc_id, n, w, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM words, lengths),
windows AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g FROM begins),
seen AS (
    SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS times,
        row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS k
    FROM windows),
held AS (
    SELECT DISTINCT doc_id, n, i + unnest(range(n)) AS place FROM seen
    WHERE CASE n WHEN 3 THEN times > 1 ELSE k > 1 END),
covered AS (
    SELECT doc_id, count(*) FILTER (n = 3) AS n_repeat_words,
        sum(size) FILTER (n = 5) AS c5, sum(size) FILTER (n = 6) AS c6,
        sum(size) FILTER (n = 7) AS c7, sum(size) FILTER (n = 8) AS c8,
        sum(size) FILTER (n = 9) AS c9, sum(size) FILTER (n = 10) AS c10
    FROM held JOIN flat USING (doc_id, place) GROUP BY doc_id),
rows AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS place FROM texts),
lines AS (
    SELECT doc_id, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS size,
        row_number() OVER (PARTITION BY doc_id, line ORDER BY place) AS k
    FROM rows WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
repeated AS (
    SELECT doc_id, count(*) AS n_dup_lines, sum(size) AS dup_line_chars
    FROM lines WHERE k > 1 GROUP BY doc_id),
figures AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
        CAST(coalesce(c5, 0) AS BIGINT) AS dup_5gram_chars,
        CAST(coalesce(c6, 0) AS BIGINT) AS dup_6gram_chars,
        CAST(coalesce(c7, 0) AS BIGINT) AS dup_7gram_chars,
        CAST(coalesce(c8, 0) AS BIGINT) AS dup_8gram_chars,
        CAST(coalesce(c9, 0) AS BIGINT) AS dup_9gram_chars,
        CAST(coalesce(c10, 0) AS BIGINT) AS dup_10gram_chars
    FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND dup_line_chars <= CAST(0.2 AS DOUBLE) * word_chars
    AND dup_5gram_chars <= CAST(0.15 AS DOUBLE) * word_chars
    AND dup_6gram_chars <= CAST(0.14 AS DOUBLE) * word_chars
    AND dup_7gram_chars <= CAST(0.13 AS DOUBLE) * word_chars
    AND dup_8gram_chars <= CAST(0.12 AS DOUBLE) * word_chars
    AND dup_9gram_chars <= CAST(0.11 AS DOUBLE) * word_chars
    AND dup_10gram_chars <= CAST(0.10 AS DOUBLE) * word_chars AS kept
FROM judged
"""


@query
def op5_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op6_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_toxicity_classifier(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op9_benchmark_templates(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_best_fit_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op11_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op11_near_vectors"] = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS u,
        list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)),
            'bool_and')
        AND list_aggregate(list_transform(embedding, lambda x: x <> 0), 'bool_or') AS good
    FROM embeddings),
links AS (
    SELECT a.r AS x, b.r AS y FROM rows a JOIN rows b ON a.r <> b.r AND a.good AND b.good
    WHERE list_cosine_similarity(a.u, b.u) >= CAST(0.95 AS DOUBLE)),
reached AS (
    SELECT r, r AS k FROM rows UNION SELECT reached.r, y FROM reached JOIN links ON k = x),
least AS (
    SELECT reached.r, min(vec_id) AS component_id FROM reached JOIN rows ON k = rows.r
    GROUP BY reached.r),
counted AS (SELECT x AS r, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM rows JOIN least USING (r) LEFT JOIN counted USING (r)
"""


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


ORACLE["op12_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS u
    FROM embeddings
    WHERE label IS NOT NULL AND list_aggregate(
        list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and')),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.u, b.u) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
        AS INTEGER) AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op13_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = r"""
WITH texts AS (
    SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        row_number() OVER () AS doc FROM documents),
found AS (
    SELECT doc, lang, source, unnest(list_transform(
        regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
    FROM texts),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term
    HAVING count(DISTINCT doc) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term)
    GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN counts USING (lang, source)
    LEFT JOIN langs USING (lang) GROUP BY lang, source),
shares AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v)::HUGEINT AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)::HUGEINT AS q
    FROM kept k JOIN langs l USING (lang)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER)
        AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""
