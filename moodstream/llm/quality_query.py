"""Quality rules of all documents, and the SQL they must agree with."""

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm.registry import query, table
from moodstream.llm.repetition import (
    LEAST_WORDS,
    LENGTHS,
    MOST_COVERED,
    MOST_LINE_CHARS,
    MOST_LINES,
    MOST_REPEATED,
    judged,
    repetition_counts,
)

_GRAMS = ", ".join(f"CASE WHEN pos + {n - 1} <= n THEN array_to_string(w[pos:pos + {n - 1}], ' ') END AS g{n}" for n in (3, *LENGTHS))
_LATER = ", ".join(
    f"g{n} IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY pos) > 1 AS l{n}" for n in LENGTHS
)
_COVER = ", ".join(
    f"max(l{n}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in LENGTHS
)
_SUMS = ", ".join(f"coalesce(sum(size) FILTER (c{n}), 0)::BIGINT AS dup_chars_{n}" for n in LENGTHS)
_RULES = " OR ".join(f"100 * dup_chars_{n} > {most} * word_chars" for n, most in MOST_COVERED.items())

SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
by_line AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS chars
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
once AS (SELECT doc_id, sum(length(line)) AS chars FROM (SELECT DISTINCT doc_id, line FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')) GROUP BY doc_id),
words AS (SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS pos FROM d),
grams AS (SELECT doc_id, pos, length(w[pos]) AS size, {_GRAMS} FROM words),
marked AS (SELECT doc_id, pos, size, g3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g3) > 1 AS r3, {_LATER} FROM grams),
covered AS (SELECT doc_id, size, max(r3) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3, {_COVER} FROM marked),
by_word AS (SELECT doc_id, count(*) AS n_words, sum(size)::BIGINT AS word_chars, (count(*) FILTER (c3)) AS n_repeat_words, {_SUMS} FROM covered GROUP BY doc_id),
counts AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  coalesce(by_line.chars - once.chars, 0)::BIGINT AS dup_line_chars, length(text) AS n_text_chars,
  {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in LENGTHS)}
  FROM d LEFT JOIN by_line USING (doc_id) LEFT JOIN once USING (doc_id) LEFT JOIN by_word USING (doc_id)),
based AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND NOT (100 * n_dup_lines > {MOST_LINES} * n_lines OR 100 * dup_line_chars > {MOST_LINE_CHARS} * n_text_chars OR {_RULES}) AS kept
FROM based
"""


@query("op9_repetition_coverage", SQL)
def op9_repetition_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judged(repetition_counts(table(spark, folder, "documents")))
