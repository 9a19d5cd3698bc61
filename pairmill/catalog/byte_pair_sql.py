"""Byte-pair encoding in DuckDB SQL: a recursive query over words, reading the vocabulary's own file."""

from __future__ import annotations

from pairmill.catalog.derive import vocabulary_file

BYTE_PAIRS = r"""WITH RECURSIVE
file AS (SELECT content FROM read_text('VOCABULARY')),
-- The character that stands for each byte.
shown AS (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS self
          FROM range(256) AS bytes(b)),
alphabet AS (
  SELECT list(CASE WHEN self THEN chr(CAST(b AS INTEGER)) ELSE chr(CAST(255 + k AS INTEGER)) END
              ORDER BY b) AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY self ORDER BY b) AS k FROM shown)),
listed AS (SELECT CAST(json_extract(content, '$.model.merges') AS VARCHAR[][]) AS m FROM file),
merges AS MATERIALIZED (
  SELECT pair[1] AS l, pair[2] AS r, rank
  FROM (SELECT unnest(m) AS pair, unnest(range(1, len(m) + 1)) AS rank FROM listed)),
vocab AS MATERIALIZED (
  SELECT unnest(json_keys(content, '$.model.vocab')) AS token,
         CAST(unnest(json_extract(content, '$.model.vocab.*')) AS BIGINT) AS id
  FROM file),
-- A run of blanks leaves its last one to what follows it.
texts AS (SELECT conv_id, turn,
                 regexp_replace(text, '(\s)(\S)', chr(1) || '\1\2', 'g') AS marked
          FROM conversations),
cut AS (
  SELECT conv_id, turn, regexp_extract_all(marked,
    '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+') AS w
  FROM texts),
placed AS (SELECT conv_id, turn, unnest(w) AS word, unnest(range(len(w))) AS pos FROM cut),
distinct_words AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM placed),
steps AS (
  SELECT word, 0 AS k, array_to_string(list_transform(range(0, CAST(len(h) // 2 AS BIGINT)),
           lambda i: chr(1) || alphabet.c[CAST('0x' || substr(h, 2 * i + 1, 2) AS INTEGER) + 1]
                     || chr(2)), '') AS s
  FROM distinct_words, alphabet
  UNION ALL
  SELECT word, k + 1, replace(s, chr(1) || l || chr(2) || chr(1) || r || chr(2),
                              chr(1) || l || r || chr(2))
  FROM (SELECT word, k, s, min(merges.rank) AS rank
        FROM (SELECT word, k, s, p, unnest(range(1, len(p))) AS i
              FROM (SELECT *, string_split(substring(s, 2, length(s) - 2), chr(2) || chr(1)) AS p
                    FROM steps)) AS pairs
        JOIN merges ON l = p[i] AND r = p[i + 1]
        GROUP BY word, k, s)
  JOIN merges USING (rank)),
final AS (SELECT word, arg_max(s, k) AS s FROM steps GROUP BY word),
symbols AS (
  SELECT word, unnest(p) AS token, unnest(range(len(p))) AS i
  FROM (SELECT word, string_split(substring(s, 2, length(s) - 2), chr(2) || chr(1)) AS p FROM final)),
encoded AS (SELECT word, list(id ORDER BY i) AS ids FROM symbols JOIN vocab USING (token) GROUP BY word)
SELECT conv_id, turn, coalesce(joined, '') AS ids
FROM texts LEFT JOIN (
  SELECT conv_id, turn, array_to_string(flatten(list(ids ORDER BY pos)), ',') AS joined
  FROM placed JOIN encoded USING (word) GROUP BY conv_id, turn) USING (conv_id, turn)""".replace(
    "VOCABULARY", vocabulary_file()
)
