"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_RATIOS = """
    SELECT lang, source, 'word_length' AS ratio, word_chars / n_words AS value FROM base WHERE n_words >= 10
    UNION ALL SELECT lang, source, 'symbols', n_symbols / n_words FROM base WHERE n_words >= 10
    UNION ALL SELECT lang, source, 'repeated', n_repeat_words / n_words FROM base WHERE n_words >= 10
    UNION ALL SELECT lang, source, 'same_lines', n_dup_lines / n_words FROM base WHERE n_words >= 10
"""

_QUALITY = rf"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), worded AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM numbered
), spots AS (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded
), grams AS (
    SELECT r, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram,
        lead(word, 4) OVER o IS NOT NULL AS whole
    FROM spots WINDOW o AS (PARTITION BY r ORDER BY i)
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams WHERE whole
), repeated AS (
    SELECT r, count(DISTINCT i + j) AS n FROM windows, range(0, 5) AS step(j) WHERE n > 1 GROUP BY r
), base AS (
    SELECT d.r, doc_id, lang, source, len(w) AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        coalesce(p.n, 0) AS n_repeat_words
    FROM worded d LEFT JOIN repeated p ON d.r = p.r
), ratios AS ({_RATIOS}
), cells AS (
    SELECT lang, source, ratio,
        CASE WHEN value > 0 THEN CAST(floor(ln(value) / 0.004987541511038968) AS INT) ELSE -1000000 END AS cell, count(*) AS n
    FROM ratios GROUP BY ALL
), merged AS (
    SELECT 1 AS level, lang, source, ratio, cell, n FROM cells
    UNION ALL SELECT 2, lang, NULL, ratio, cell, sum(n) FROM cells GROUP BY lang, ratio, cell
    UNION ALL SELECT 3, NULL, NULL, ratio, cell, sum(n) FROM cells GROUP BY ratio, cell
), ranked AS (
    SELECT level, lang, source, ratio, cell,
        sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY cell) AS below,
        sum(n) OVER (PARTITION BY level, lang, source, ratio) AS docs
    FROM merged
), cuts AS (
    SELECT level, lang, source, ratio, max(docs) AS docs,
        min(cell) FILTER (4 * below >= docs) AS c1, min(cell) FILTER (4 * below >= 3 * docs) AS c3
    FROM ranked GROUP BY ALL
), quartiles AS (
    SELECT *, CASE WHEN c1 > -1000000 THEN exp((c1 + 0.5) * 0.004987541511038968) ELSE 0 END AS q1,
        CASE WHEN c3 > -1000000 THEN exp((c3 + 0.5) * 0.004987541511038968) ELSE 0 END AS q3
    FROM cuts
), chosen AS (
    SELECT a.lang, a.source, a.ratio,
        CASE WHEN a.docs >= 100 THEN a.q1 WHEN b.docs >= 100 THEN b.q1 ELSE c.q1 END AS q1,
        CASE WHEN a.docs >= 100 THEN a.q3 WHEN b.docs >= 100 THEN b.q3 ELSE c.q3 END AS q3
    FROM quartiles a
    JOIN quartiles b ON b.level = 2 AND b.lang IS NOT DISTINCT FROM a.lang AND b.ratio = a.ratio
    JOIN quartiles c ON c.level = 3 AND c.ratio = a.ratio
    WHERE a.level = 1
), fences AS (
    SELECT lang, source,
        max(q1 - 4 * greatest(q3 - q1, 0.5)) FILTER (ratio = 'word_length') AS low,
        max(q3 + 4 * greatest(q3 - q1, 0.5)) FILTER (ratio = 'word_length') AS high,
        max(q3 + 4 * greatest(q3 - q1, 0.05)) FILTER (ratio = 'symbols') AS symbols,
        max(q3 + 4 * greatest(q3 - q1, 0.05)) FILTER (ratio = 'repeated') AS repeated,
        max(q3 + 4 * greatest(q3 - q1, 0.02)) FILTER (ratio = 'same_lines') AS same_lines
    FROM chosen GROUP BY lang, source
), judged AS (
    SELECT b.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, f.*
    FROM base b LEFT JOIN fences f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(word_chars / n_words BETWEEN low AND high AND n_symbols / n_words <= symbols
        AND n_repeat_words / n_words <= repeated AND n_dup_lines / n_words <= same_lines, false) AS kept
FROM judged
"""

_DIVERGENCE = r"""
WITH named AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM named
), terms AS (
    SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM named
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM terms GROUP BY ALL
), cells AS (
    SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
    SELECT c.*, 1 + 1000000000::HUGEINT * (n + 1) // ((sum(n) OVER (PARTITION BY c.lang, c.source)) + v)::HUGEINT AS p,
        1 + 1000000000::HUGEINT * (lang_n + 1) // (total + v)::HUGEINT AS lang_p
    FROM cells c JOIN langs l ON l.lang = c.lang
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), telling AS (
    SELECT lang, source, term AS item, ((p - lang_p) * (p - lang_p) // lang_p)::BIGINT AS value FROM shares WHERE n > 0 AND p > lang_p
)
SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM telling
) WHERE rank <= 200
"""

_SPELLING = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
    FROM range(256) AS s(i)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS bytes FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1 : 2 * i + 2])::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS h
    FROM counted, crc_table
), spelt AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS shorter, substr(word, 1, i) || '?' || substr(word, i + 2) AS hole
    FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.hole = b.hole AND a.word <> b.word
    UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.shorter = w.word
    UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.shorter = w.word
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
), formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
        CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), chains AS (
    SELECT word, word AS root, 0 AS steps FROM words
    UNION ALL SELECT c.word, f.form, steps + 1 FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), lasts AS (
    SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN lasts l ON l.word = f.word
"""

ORACLE_SQL = {
    "op2_quality_rules": _QUALITY,
    "op11_source_divergence": _DIVERGENCE,
    "op12_spelling_variants": _SPELLING,
}
