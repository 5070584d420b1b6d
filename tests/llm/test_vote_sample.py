"""The labelled sample of the quality classifier."""

import pyarrow as pa

from driftwell.llm import neighbours


def test_sample_holds_only_labels_of_texts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MAX_LABELLED", 5)
    docs = spark.createDataFrame([(i, f"text {i}" if i % 2 else None) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(2000)], "doc_id long, quality int")
    assert neighbours.labelled_sample(docs, labels).count() == 5


def test_long_labelled_text_has_the_counts_it_is_scored_with(spark, monkeypatch):
    text = "again " * 70_000
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    monkeypatch.setattr(neighbours, "Model", lambda counts, _: counts)
    counts = neighbours.fit(docs, labels)
    assert len(counts) and (counts == neighbours.term_counts(pa.array([text]))).all()
