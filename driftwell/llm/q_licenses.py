"""Query of the licence scan."""

from __future__ import annotations

from driftwell.llm import licenses
from driftwell.llm.catalog import query
from driftwell.plans.catalog import table


def _sql_map(values):
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in values.items()) + "}"


_CLEAN = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
SQL = f"""
WITH known AS (SELECT {_sql_map(licenses.KNOWN)} AS m, {_sql_map(licenses.LICENCE_OF)} AS names),
cut AS (
    SELECT row_number() OVER () AS rid, doc_id,
           string_split(regexp_replace(coalesce(text, ''), '{licenses.ENDS}', '\\1' || chr(1), 'g'), chr(1)) AS s
    FROM documents
),
sentences AS (SELECT rid, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS s FROM cut),
lines AS (
    SELECT rid, i, s, unnest(range(1, len(l) + 1)) AS j, unnest(l) AS line
    FROM (SELECT rid, i, s, string_split(s, chr(10)) AS l FROM sentences)
),
looked AS (
    SELECT rid, i, j, m[{_CLEAN.format("s")}] AS whole, m[{_CLEAN.format("line")}] AS part FROM lines, known
),
found AS (
    SELECT rid, i, j, coalesce(whole, part) AS k FROM looked WHERE coalesce(whole, part) IS NOT NULL
    AND (whole IS NULL OR j = 1)
),
ids AS (SELECT rid, string_agg('<' || k || '>', '' ORDER BY i, j) AS ids FROM found GROUP BY rid),
runs AS (
    SELECT cut.rid, doc_id, coalesce(ids, '') AS ids, regexp_extract_all(coalesce(ids, ''), '{licenses.PATTERN}') AS runs
    FROM cut LEFT JOIN ids ON cut.rid = ids.rid
)
SELECT doc_id, (length(ids) - length(replace(ids, '<', '')))::BIGINT AS n_sentences, ids AS sentence_ids,
       coalesce(array_to_string(list_transform(runs, lambda r: names[r]), ','), '') AS licenses,
       len(runs)::BIGINT AS n_licenses
FROM runs, known
"""


@query("op6_license_sentence_rules", SQL)
def license_sentence_rules(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))
