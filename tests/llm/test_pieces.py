"""The SentencePiece table against the library, and its defined cases."""

import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from driftwell.llm.pieces import PieceTable, encode_pieces, piece_table
from driftwell.llm.q_pieces import MODEL
from driftwell.llm.registered import LLM_QUERIES


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as f:
        return piece_table(f.read())


def ids(pieces: PieceTable, text: str) -> list[int]:
    packed = pieces.encode(text)
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_query(spark, data_dir, library):
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op11_piece_table"].job(spark, data_dir).collect()}
    docs = pq.read_table(f"{data_dir}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for d in docs:
        wanted = library.encode(d["text"] or "")
        assert got[d["doc_id"]] == (len(wanted), sha(",".join(map(str, wanted))), sha(library.decode(wanted)))


def test_any_text(pieces, library):
    rnd = random.Random(5)
    letters = [*"abeth é中本語▁\n\t😀\x001=Ω�ก", "  ", "    ", "ing", "the ", "==", "<s>", "‍", "　"]
    vocabulary = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    for k in range(3000):
        text = "".join(rnd.choices(letters if k % 2 else vocabulary, k=rnd.randrange(40 if k % 2 else 8)))
        assert ids(pieces, text) == library.encode(text), text


def test_any_ids_decode(pieces, library):
    rnd = random.Random(6)
    for k in range(3000):
        some = [rnd.randrange(300 if k % 2 else 32000) for _ in range(rnd.randrange(12))]
        assert pieces.decode(some) == library.decode(some), some


def test_one_last_token_for_each_prefix(pieces, library):
    text = "▁preprocessing▁▁▁of▁tokens"
    last = [*pieces.table(text), -1]  # at -1: the empty prefix
    for end in range(1, len(text) + 1):
        found = (pieces.ids.get(text[start:end]) for start in range(end))
        fitting = [t for t in found if t is not None and pieces.compatible(last[end - 1 - pieces.sizes[t]], t)]
        assert fitting == [last[end - 1]]
        assert end == 1 or fitting[0] == library.encode(text[1:end].replace("▁", " "))[-1]


def test_cases(spark, library):
    long = "".join(random.Random(7).choices("abcdefgh中文", k=300_000))  # no blank to cut at
    rows = [(1, None), (2, ""), (3, " "), (4, " \n"), (5, "x y"), (5, "x y"), (None, "x"), (6, long), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wide = docs.withColumn("ids", F.lit(0)).withColumn("decoded", F.lit("z")).withColumn("token", F.lit(1.0))
    got = sorted((r.doc_id or 0, r.ids, r.decoded) for r in encode_pieces(wide, MODEL).collect())
    wanted = sorted((i or 0, library.encode(t or ""), t or "") for i, t in rows)
    assert got == wanted
    assert encode_pieces(wide.where("false"), MODEL).count() == 0
    assert [f.simpleString() for f in encode_pieces(wide, MODEL).schema][1:] == ["ids:array<int>", "decoded:string"]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        PieceTable(b"")
