"""Every text operator as a query over whole tables, with its SQL where SQL can state it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.llm.common import stored, table
from delaykit.operators.numbering import numbered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


OP1_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), judged AS (
  SELECT *, list_filter(lines, lambda l:
      right(rtrim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)
        NOT IN ('.', '!', '?', ':', ';', '…', '。', '！', '？', '"', '''', '”', '’', '»', ')', ']')
      OR regexp_matches(l, '(?s)([|»›•·>].*){3}')
      OR (length(l) <= 40 AND regexp_matches(l, '(?i)^[^A-Z]*(home|menu|log ?in|sign (in|up)|register|next|previous|back to top|read more|share this|skip to content)[^A-Z]*\z'))
      OR len(regexp_extract_all(l, '###|\*\*\*|\$\$\$|%%%|&&&')) >= 2
      OR regexp_matches(l, '(?s)(!!.*){3}')
      OR regexp_matches(lower(l), 'cookie (policy|settings|consent)|privacy policy|terms of (use|service)|all rights reserved|javascript|lorem ipsum|click here')
      OR (regexp_matches(l, '[A-Z]') AND NOT regexp_matches(l, '[a-z]')
          AND len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 3)) AS bad
  FROM texts
), tokens AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM texts
), windows AS (
  SELECT doc_id, p, concat_ws(' ', w, lead(w, 1) OVER x, lead(w, 2) OVER x, lead(w, 3) OVER x, lead(w, 4) OVER x) AS s,
    lead(w, 4) OVER x IS NOT NULL AS whole
  FROM tokens WINDOW x AS (PARTITION BY doc_id ORDER BY p)
), repeated AS (
  SELECT doc_id, count(DISTINCT p + k) AS n
  FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS copies FROM windows WHERE whole), range(5) AS r(k)
  WHERE copies > 1 GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(bad) AS n_removed_lines,
    CAST(len(regexp_extract_all(array_to_string(bad, chr(10)), '[^\x20\x09-\x0D]+')) AS BIGINT) AS lost_words
  FROM judged LEFT JOIN repeated USING (doc_id)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost_words <= 40 * n_words AND n_words - lost_words >= 10 AS kept,
  n_lines, n_removed_lines, lost_words
FROM failed
"""


@query(OP1_SQL)
def op1_quality_rules(spark, sf_dir):
    from delaykit.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), texts=False)


@query()
def op7_language_id(spark, sf_dir):
    from delaykit.llm.language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


@query()
def op8_near_dedup(spark, sf_dir):
    from delaykit.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_packing(spark, sf_dir):
    from delaykit.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query()
def op2_fingerprints(spark, sf_dir):
    from delaykit.llm.fingerprints import compare_neighbours

    return compare_neighbours(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads
), fives AS (
  SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, CAST(1 + 5 * i AS INT), 5))::BIGINT) AS n FROM firsts
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((n[CAST(i // 4 + 1 AS INT)] >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to, true AS complete
FROM fives
"""


@query(OP10_SQL)
def op10_warc(spark, sf_dir):
    from delaykit.llm.warc import page_records, read_archives, write_archives
    from delaykit.session import new_work_dir

    path = f"{new_work_dir(spark)}/archives"
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(read_archives(spark, path))


@query()
def op3_lm_scoring(spark, sf_dir):
    from delaykit.llm.lm_scoring import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


@query()
def op4_sentence_pieces(spark, sf_dir):
    from delaykit.llm.sentence_pieces import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def mailed(turns: DataFrame) -> DataFrame:
    """Turns of conversations as mails: each quotes the two turns before it, the older one twice over.

    A turn whose number is divisible by 3 quotes the one before it alone. Mails are numbered in the order of
    conversation and turn. Of several rows of one turn each is a mail, and the first by role and text is quoted.
    """
    own = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    one = stored(own.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("first")), "turns")
    marked = lambda text: F.regexp_replace(text, r"(?m)^", "> ")

    def before(n: int) -> DataFrame:
        return one.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("first.text").alias(f"text_{n}"))

    mails = numbered(own, ["conv_id", "turn", "role", "text"], "message_id")
    first = mails.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    # What the message before looked like, without what it quoted from further back.
    above = F.when(
        F.col("text_2").isNotNull() & (F.col("turn") % 3 != 0), F.concat(marked(F.col("text_2")), F.lit("\n"), F.col("text_1"))
    ).otherwise(F.col("text_1"))
    body = F.when(
        F.col("text_1").isNotNull(), F.concat(F.lit("On Monday somebody wrote:\n"), marked(above), F.lit("\n"), F.col("text"))
    ).otherwise(F.col("text"))
    return first.select("message_id", "role", body.alias("text"))


@query()
def op5_chat_quotes(spark, sf_dir):
    from delaykit.llm.chat_quotes import conversations

    return conversations(mailed(table(spark, sf_dir, "conversations")))


@query()
def op6_importance(spark, sf_dir):
    from delaykit.llm.importance import importance_resample

    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return importance_resample(table(spark, sf_dir, "documents"), good)


OP11_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query(OP11_SQL)
def op11_hard_negatives(spark, sf_dir):
    from delaykit.llm.hard_negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), tokens AS (
  SELECT lang, source, d, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM tokens GROUP BY ALL HAVING count(DISTINCT d) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
), grid AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000 * (coalesce(c, 0) + 1)::HUGEINT) // (s.n + v) AS p,
    1 + (1000000000 * (total + 1)::HUGEINT) // (l.n + v) AS q
  FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM grid WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""


@query(OP12_SQL)
def op12_source_divergence(spark, sf_dir):
    from delaykit.llm.source_divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


@query()
def op13_token_counts(spark, sf_dir):
    from delaykit.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
