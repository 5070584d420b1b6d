"""Query of byte-level substring dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.llm.bwt import without_repeats
from driftwell.llm.catalog import query
from driftwell.plans.catalog import table


SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM b),
strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM starts),
again AS (SELECT doc_id, i FROM strings QUALIFY count(*) OVER (PARTITION BY m) > 1),
runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (
        SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new
            FROM again)) GROUP BY doc_id, run
),
gaps AS (
    SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM runs
    UNION ALL SELECT b.doc_id, max(z), any_value(len(h) // 2) FROM runs JOIN b ON b.doc_id = runs.doc_id GROUP BY b.doc_id
),
kept AS (
    SELECT gaps.doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, (2 * (z - a))::BIGINT), '' ORDER BY a) AS t
    FROM gaps JOIN b ON b.doc_id = gaps.doc_id WHERE z > a GROUP BY gaps.doc_id
),
sums AS (SELECT doc_id, sum(z - a)::BIGINT AS gone, count(*)::BIGINT AS n FROM runs GROUP BY doc_id)
SELECT b.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE coalesce(t, '') END)) AS kept_sha256
FROM b LEFT JOIN sums ON sums.doc_id = b.doc_id LEFT JOIN kept ON kept.doc_id = b.doc_id
"""


@query("op8_bwt_interleave", SQL)
def bwt_interleave(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
