"""Query of the divergence rules."""

from __future__ import annotations

from driftwell.llm import divergence as rules
from driftwell.llm.catalog import query
from driftwell.plans.catalog import table

_CLASS = ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:''\"?!()\-]")
_COUNT = [f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in _CLASS]
_COUNT += [
    "length(regexp_replace(t, '[^\\x00-\\x7F]', '', 'g')) - (" + " + ".join(f"({c})" for c in _COUNT) + ")",
    r"length(t) - length(regexp_replace(t, '[\x{80}-\x{7FF}]', '', 'g'))",
    r"length(regexp_replace(t, '[\x{0}-\x{7FF}]', '', 'g'))",
]
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, lang FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
spelled AS (SELECT rid, coalesce(lang, '') AS lang, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
five AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
grams AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM five),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
repeated AS (
    SELECT rid, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY rid
),
base AS (
    SELECT w.rid, doc_id, lang, len(ws) AS n_words,
           coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
             - len(list_distinct(list_filter(string_split(t, chr(10)),
                   lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
           coalesce(r.n, 0) AS n_repeat_words, length(t) AS chars
    FROM w LEFT JOIN repeated r ON w.rid = r.rid
),
classes AS (
    SELECT rid, lang, unnest([{", ".join(f"' {i}'" for i in range(8))}]) AS cell, unnest([{", ".join(_COUNT)}]) AS n FROM d
),
words AS (SELECT lang, word AS cell, count(*) AS n FROM spelled GROUP BY ALL),
sizes AS (SELECT lang, sum(n) AS words, sum(sum(n)) OVER () AS all_words FROM words GROUP BY lang),
refs AS (
    SELECT lang, cell, n, words FROM words JOIN sizes USING (lang)
    WHERE lang <> '' AND words >= {rules.LEAST_SHARE} * all_words AND n >= {rules.COMMON} * words
    UNION ALL
    SELECT '{rules.ALL}', cell, sum(n), any_value(all_words) FROM words JOIN sizes USING (lang)
    GROUP BY cell HAVING sum(n) >= {rules.COMMON} * any_value(all_words)
),
named AS (SELECT lang FROM sizes WHERE lang <> '' AND words >= {rules.LEAST_SHARE} * all_words),
chosen AS (SELECT rid, CASE WHEN lang IN (SELECT lang FROM named) THEN lang ELSE '{rules.ALL}' END AS ref FROM d),
cells AS (
    SELECT ref, cell, sum(n) AS q FROM (
        SELECT c.lang AS ref, cell, n FROM classes c JOIN named ON c.lang = named.lang
        UNION ALL SELECT '{rules.ALL}', cell, n FROM classes
    ) GROUP BY ALL
),
class_pairs AS (
    SELECT chosen.rid, classes.n / nullif(sum(classes.n) OVER (PARTITION BY chosen.rid), 0) AS p,
           cells.q / sum(cells.q) OVER (PARTITION BY chosen.rid) AS q
    FROM chosen JOIN classes USING (rid) JOIN cells ON cells.ref = chosen.ref AND cells.cell = classes.cell
),
found AS (
    SELECT chosen.rid, spelled.word AS cell, count(*) AS n FROM chosen JOIN spelled USING (rid)
    JOIN refs ON refs.lang = chosen.ref AND refs.cell = spelled.word GROUP BY ALL
),
word_cells AS (
    SELECT chosen.rid, coalesce(found.n, 0) AS n, refs.n AS q FROM chosen JOIN refs ON refs.lang = chosen.ref
    LEFT JOIN found ON found.rid = chosen.rid AND found.cell = refs.cell
    UNION ALL
    SELECT chosen.rid, b.n_words - coalesce((SELECT sum(n) FROM found WHERE found.rid = chosen.rid), 0),
           (SELECT any_value(words) - sum(n) FROM refs WHERE refs.lang = chosen.ref)
    FROM chosen JOIN base b USING (rid)
),
word_pairs AS (
    SELECT rid, n / nullif(sum(n) OVER (PARTITION BY rid), 0) AS p, q / sum(q) OVER (PARTITION BY rid) AS q FROM word_cells
),
far AS (
    SELECT rid, kind, round(sqrt(greatest(sum(
        CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)), 4) AS js
    FROM (SELECT rid, 'c' AS kind, p, q FROM class_pairs UNION ALL SELECT rid, 'w', p, q FROM word_pairs)
    WHERE p IS NOT NULL GROUP BY ALL
),
judged AS (
    SELECT b.*, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED_PCT} * n_words AS base_failed,
           CASE WHEN chars >= {rules.MIN_CHARS} THEN coalesce(c.js, 0) END AS class_distance,
           CASE WHEN n_words >= {rules.MIN_WORDS} THEN coalesce(v.js, 0) END AS word_distance
    FROM base b LEFT JOIN far c ON c.rid = b.rid AND c.kind = 'c' LEFT JOIN far v ON v.rid = b.rid AND v.kind = 'w'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance, 0) <= {rules.MAX_CLASS_DISTANCE}
         AND coalesce(word_distance, 0) <= {rules.WORD_FLOOR} + {rules.WORD_NOISE} / sqrt(greatest(n_words, 1)) AS kept,
       class_distance, word_distance
FROM judged
"""


@query("op1_divergence_rules", SQL)
def divergence_rules(spark, sf_dir):
    return rules.quality_rules(table(spark, sf_dir, "documents"))
