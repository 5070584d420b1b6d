"""Query of substring dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.llm.catalog import query
from driftwell.llm.seeds import without_repeats
from driftwell.plans.catalog import table

SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w WHERE len(ws) >= 20),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 19), ' ')) AS h FROM starts),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, (SELECT unnest(range(0, 20)) AS j)),
spelled AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
kept AS (
    SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.i) AS t, count(*) AS n
    FROM spelled s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query("op3_seed_and_extend", SQL)
def seed_and_extend(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )
