"""Letters around removed spans."""

from driftwell.llm.bwt import cleaned_documents
from driftwell.llm.table import bounded_batches


def test_replacement_characters_of_the_input_stay(spark):
    bounded_batches(spark)
    shared = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(1, f"a\ufffdb {shared} c\ufffdd"), (2, f"x\ufffdy {shared} z")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in cleaned_documents(docs).collect()}
    assert got[1].count("\ufffd") == 2 and got[2].count("\ufffd") == 1
    assert got[1].startswith("a\ufffdb") and got[1].endswith("c\ufffdd") and "w50" not in got[1] + got[2]
