"""One query per operator over its whole table, and SQL with the same rows where SQL can express it."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontamination, mixture, near_duplicates, ordinal_quality, personal_data, pieces, quality_rules, repeated_lines, repeated_passages, source_divergence, suffix_duplicates, toxicity
from .common import table

#: Folder of the public tokenizers; its module gives the files' places.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    if TOKENIZERS not in sys.path:
        sys.path.append(TOKENIZERS)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ordinal_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return ordinal_quality.rated(docs, ordinal_quality.train(docs, table(spark, base, "labels")))


def op2_personal_data(spark: SparkSession, base: str) -> DataFrame:
    return personal_data.personal_data_digest(table(spark, base, "documents"))


def op3_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return decontamination.contaminated(table(spark, base, "documents"), table(spark, base, "benchmark")).drop("key")


def op4_near_duplicates(spark: SparkSession, base: str) -> DataFrame:
    return near_duplicates.classes(table(spark, base, "documents"))


def op5_suffix_duplicates(spark: SparkSession, base: str) -> DataFrame:
    return suffix_duplicates.without_repeated_bytes_digest(table(spark, base, "documents"))


def op6_sentence_pieces(spark: SparkSession, base: str) -> DataFrame:
    return pieces.encoded_digest(table(spark, base, "documents"), tokenizer_path(PIECE_MODEL))


def op7_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    return quality_rules.judged(table(spark, base, "documents")).drop("lang", "source")


def op8_repeated_passages(spark: SparkSession, base: str) -> DataFrame:
    return repeated_passages.without_repeated_passages_digest(table(spark, base, "documents"))


def op9_repeated_lines(spark: SparkSession, base: str) -> DataFrame:
    kept = repeated_lines.without_repeated_lines(table(spark, base, "documents"))
    digest = F.sha2(F.coalesce(F.col("doc.text").cast("string"), F.lit("")), 256).alias("kept_sha256")
    return kept.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", digest)


def op10_toxicity(spark: SparkSession, base: str) -> DataFrame:
    return toxicity.toxicity(table(spark, base, "documents"), table(spark, base, "labels"))


def op11_mixture(spark: SparkSession, base: str) -> DataFrame:
    return mixture.mixture_digest(table(spark, base, "documents"))


def op12_conversation_repair(spark: SparkSession, base: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, base, "conversations"))


def op13_source_divergence(spark: SparkSession, base: str) -> DataFrame:
    return source_divergence.divergence(table(spark, base, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality,
        op2_personal_data,
        op3_decontamination,
        op4_near_duplicates,
        op5_suffix_duplicates,
        op6_sentence_pieces,
        op7_quality_rules,
        op8_repeated_passages,
        op9_repeated_lines,
        op10_toxicity,
        op11_mixture,
        op12_conversation_repair,
        op13_source_divergence,
    )
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {
    "op8_repeated_passages": """
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50),
runs AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS run FROM starts),
later AS (SELECT doc_id, i FROM runs QUALIFY min(doc_id) OVER (PARTITION BY run) < doc_id),
levels AS (
  SELECT doc_id, i, 50 AS words, dense_rank() OVER (ORDER BY run) AS g FROM runs
  QUALIFY min(doc_id) OVER (PARTITION BY run) < max(doc_id) OVER (PARTITION BY run)
  UNION ALL
  SELECT a.doc_id, a.i, 2 * a.words, dense_rank() OVER (ORDER BY a.g, b.g)
  FROM levels a JOIN levels b ON a.doc_id = b.doc_id AND b.i = a.i + a.words
  QUALIFY min(a.doc_id) OVER (PARTITION BY a.g, b.g) < max(a.doc_id) OVER (PARTITION BY a.g, b.g)
), longest AS (SELECT doc_id, max(words) AS words FROM levels GROUP BY doc_id),
marked AS (
  SELECT words.doc_id, words.i, word,
         max(later.i) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS start
  FROM words LEFT JOIN later ON words.doc_id = later.doc_id AND words.i = later.i
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(start) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (start IS NULL) AS text
  FROM marked GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(longest.words, 0)::BIGINT AS longest_repeat, sha256(coalesce(text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN longest USING (doc_id)
""",
    "op9_repeated_lines": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), f AS (SELECT * FROM l WHERE trim(line, {_SPACES}) <> ''),
w AS (
  SELECT doc_id, i, line AS l1, lead(line, 1) OVER o AS l2, lead(line, 2) OVER o AS l3,
         lead(i, 1) OVER o AS i2, lead(i, 2) OVER o AS i3
  FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT doc_id, i, i2, i3 FROM w WHERE i3 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, i) > 1
), gone AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM later)
SELECT l.doc_id, count(*) FILTER (trim(l.line, {_SPACES}) <> '') AS n_lines, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
GROUP BY l.doc_id
""",
    "op11_mixture": """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
  FROM s WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), expected AS (
  SELECT *, least(3000000000, floor(target / nullif(source_size, 0) * 1000000000 + 0.5)::BIGINT)::HUGEINT AS e,
         ('0x' || substr(md5('mixture-1:' || coalesce('=' || source, 'null')), 1, 15))::BIGINT % 1000000000 AS o
  FROM targets
), placed AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, md5(coalesce(doc_id::VARCHAR, '')))::HUGEINT AS i FROM d
)
SELECT doc_id, size, source_size, target,
       (size * coalesce((e * i + o) // 1000000000 - (e * (i - 1) + o) // 1000000000, 0))::BIGINT AS taken
FROM placed JOIN expected ON placed.source IS NOT DISTINCT FROM expected.source
""",
    "op13_source_divergence": """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), terms AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM terms GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN terms USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(sum(own.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs ON g.lang = langs.lang LEFT JOIN own ON g.lang = own.lang AND g.source = own.source
  GROUP BY g.lang, g.source
), shares AS (
  SELECT g.lang, g.source, terms.term, coalesce(own.n, 0) AS own_n,
         (1 + 1000000000::HUGEINT * (coalesce(own.n, 0) + 1) // (g.n + g.v)::HUGEINT)::HUGEINT AS p,
         (1 + 1000000000::HUGEINT * (terms.n + 1) // (langs.n + langs.v)::HUGEINT)::HUGEINT AS q
  FROM groups g JOIN terms ON g.lang = terms.lang JOIN langs ON g.lang = langs.lang
  LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = terms.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE own_n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
""",
    "op12_conversation_repair": """
WITH RECURSIVE bits AS (
  SELECT byte, byte AS crc, 0 AS step FROM (SELECT unnest(range(256)) AS byte)
  UNION ALL
  SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8
), crc_table AS (SELECT list(crc ORDER BY byte) AS entries FROM bits WHERE step = 8),
plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1]))) % 20 AS damage
  FROM conversations, crc_table
), broken AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy
  FROM plain WHERE damage <> 0
), placed AS (
  SELECT *, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM broken
), turns AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN again THEN 'd'
              WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN '.' ELSE 't' END AS fault
  FROM placed
), totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM turns GROUP BY conv_id
), inserts AS (
  SELECT * FROM (VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
    (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
    (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])) t(p, q, letters, lines)
), edits AS (
  SELECT * FROM (VALUES ('K', 0, 1, 's', ''), ('K', 0, 2, 'u', ''), ('K', 1, 2, 'u', ''), ('K', 3, 2, 'u', ''), ('K', 2, 3, 'a', ''),
    ('R', 0, 2, NULL, 'user'), ('R', 1, 2, NULL, 'user'), ('R', 2, 3, NULL, 'assistant'), ('R', 3, 2, NULL, 'user'),
    ('D', 0, 0, NULL, ''), ('D', 1, 1, NULL, ''), ('D', 2, 2, NULL, ''), ('D', 3, 3, NULL, '')) t(letter, p, q, initial, role)
), parsed AS (
  SELECT conv_id, 0 AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM totals
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, {'c': cost, 'a': audit}), arg_min(lines, {'c': cost, 'a': audit})
  FROM (
    SELECT t.conv_id, t.i::INTEGER AS i, e.q, p.audit || n.letters || e.letter AS audit,
           p.cost + 3 * len(n.letters) + CASE e.letter WHEN 'K' THEN 0 WHEN 'R' THEN 3 ELSE 4 END
             + CASE WHEN t.fault = 't' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
           p.lines || n.lines || CASE e.letter WHEN 'K' THEN [t.role || ':' || t.text] WHEN 'R' THEN [e.role || ':' || t.text] ELSE [] END AS lines
    FROM parsed p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1 JOIN inserts n ON n.p = p.q
    JOIN edits e ON e.p = n.q AND (e.letter = 'D' OR t.fault NOT IN ('b', 'd') AND (e.letter = 'R' OR e.initial = t.initial))
  ) GROUP BY conv_id, i, q
), ended AS (
  SELECT t.conv_id, gaps, blank, duplicate, truncated, illegal, min({'c': cost + 3 * len(letters), 'a': audit || letters}) AS best,
         arg_min(p.lines || n.lines, {'c': cost + 3 * len(letters), 'a': audit || letters}) AS lines
  FROM totals t JOIN parsed p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = t.n JOIN inserts n ON n.p = p.q AND n.q IN (0, 3)
  GROUP BY ALL
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
""",
}
