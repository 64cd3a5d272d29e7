"""SQL counterparts of the operator queries that SQL can express."""

from __future__ import annotations

# fixed value: the word pattern
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_EXACT = """
WITH norm AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM norm WINDOW same AS (PARTITION BY body)
"""

_SUBSTRING = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
blocks AS (
    SELECT doc_id, pos, array_to_string(words[pos + 1 : pos + 50], ' ') AS block
    FROM (SELECT doc_id, words, unnest(range(len(words) - 49)) AS pos FROM docs WHERE len(words) >= 50)
),
owned AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY block) AS owner FROM blocks) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS place FROM owned),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs),
kept AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS body, count(*) AS n
    FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.words) AS n_words, len(d.words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

_QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, pos, words[pos + 1 : pos + 8] AS w
    FROM (SELECT doc_id, words, unnest(range(len(words) - 7)) AS pos FROM docs WHERE len(words) >= 8)
),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS place FROM twice) GROUP BY doc_id),
measured AS (
    SELECT d.doc_id, text, len(words) AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words
    FROM docs d LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
        OR 10 * n_symbols > 3 * n_words
        OR 10 * len(regexp_extract_all(text, '\p{{Lu}}')) > 6 * word_chars
        OR 10 * len(regexp_extract_all(text, '!')) > 5 * n_words
        OR word_chars > 30 * n_words
        OR 10 * n_dup_lines > 7 * len(string_split(text, chr(10)))) AS kept
FROM measured
"""

ORACLE_SQL: dict[str, str] = {"op3_substring_dedup": _SUBSTRING, "op7_exact_dedup": _EXACT, "op9_quality_rules": _QUALITY}
