"""Query of the BPE encoder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from driftwell.llm.bpe import encode_texts
from driftwell.llm.catalog import query
from driftwell.plans.catalog import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def digests(encoded):
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op5_bpe_forced_boundaries")
def bpe_forced_boundaries(spark, sf_dir):
    return digests(encode_texts(table(spark, sf_dir, "documents"), VOCABULARY))
