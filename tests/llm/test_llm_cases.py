"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_queries import brute_bytes, brute_classes, words

import corpus_pipeline
from driftwell.llm import bagminhash, bpe, bwt, divergence, fingerprints, interleave, licenses, mixing, neighbours, seeds, sharding
from driftwell.llm.blocks import Words, flat, sliding_argmin
from driftwell.llm.q_bpe import VOCABULARY
from driftwell.llm.table import bounded_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, on documents.
CLASH = ["k", "th", "node", "bucket", "score", "row", "own", "label", "cut", "cell", "anchor", "start", "size", "copy", "h"]


def long_text(seed, n):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    bounded_batches(spark)
    base = long_text(1, 300)
    very = long_text(2, 60_000)
    rows = [
        (1, base, "en", "a", None),
        (2, base, "en", "a", 5),  # an equal text
        (3, base.replace("w1", "x1", 1), "en", "b", 0),  # a near copy
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "de", "", 4),
        (7, "one two three", "de", "c", 13),
        (8, very, "en", "b", None),
        (8, very, "en", "b", None),  # a repeated row
        (9, "a" * 3000 + "\nReleased under the MIT License.", "en", "c", None),
        (None, long_text(3, 40), "fr", "a", 7),
        (None, None, None, None, None),
        (10, "é€😀 " * 200 + "<|endoftext|>", "fr", None, 1),
        (11, "same line\n" * 40, "en", "a", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for i, name in enumerate(CLASH):
        df = df.withColumn(name, F.lit(i))
    return df, rows


@pytest.fixture(scope="module")
def none(docs):
    return docs[0].where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (9, 0, 0), (11, 0, 1), (11, 0, 1), (7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def keyed(rows):
    return sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in rows), key=str)


def test_rules(docs, none):
    df, rows = docs
    got = divergence.quality_rules(df).collect()
    assert len(got) == len(rows) and divergence.quality_rules(none).count() == 0
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[4].base_failed and by_id[5].base_failed and by_id[7].n_words == 3 and by_id[7].base_failed
    assert by_id[11].n_dup_lines == 39 and by_id[11].n_repeat_words == 80 and not by_id[11].kept
    assert by_id[8].n_words == 60_000 and by_id[9].word_chars == 3000 + len("ReleasedundertheMITLicense.")
    assert by_id[7].class_distance is None and by_id[7].word_distance is None


def test_fingerprints(docs, none):
    df, rows = docs
    got = fingerprints.with_neighbours(df).collect()
    assert len(got) == len(rows) and fingerprints.with_neighbours(none).count() == 0
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    assert prints[1] == prints[2] != prints[3] and prints[4] == prints[5]
    assert {r.fingerprint for r in fingerprints.fingerprints(df).collect()} >= set(prints.values())
    alone = fingerprints.with_neighbours(df.where("doc_id = 7")).first()
    assert alone.near_next == 1.0 and alone.n_chars == 13


def test_prefix_hashes_answer_spans():
    rnd = random.Random(4)
    a, b = ("".join(rnd.choice("ab") for _ in range(60)) for _ in range(2))
    x, y = fingerprints.PrefixHashes.of(a), fingerprints.PrefixHashes.of(b)
    for i in range(0, 60, 7):
        for j in range(0, 60, 5):
            n = next((n for n in range(61) if i + n >= 60 or j + n >= 60 or a[i + n] != b[j + n]), 0)
            assert x.common_extension(i, y, j) == n
    joined = x.spliced(20, y, 30)
    assert joined.span(0, 50) == fingerprints.PrefixHashes.of(a[:20] + b[:30]).span(0, 50)


def test_seeds(spark, docs, none):
    df, rows = docs
    got = sorted(map(tuple, seeds.without_repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)
    assert len(got) == len(rows) and seeds.without_repeats(none).count() == 0
    texts = {}
    for r in rows:
        texts.setdefault((r[0] is not None, r[0] or 0, r[1] or ""), None)
    # documents in order; equal rows are one document
    order = sorted(texts, key=lambda k: (k[0], k[1]))
    seen, want = {}, {}
    for key in order:
        w = words(key[2])
        for i in range(len(w) - 19):
            seen.setdefault(tuple(w[i : i + 20]), (key, i))
        gone = set()
        for i in range(len(w) - 19):
            if seen[tuple(w[i : i + 20])] != (key, i):
                gone |= set(range(i, i + 20))
        want[key] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    assert got == sorted(((r[0], *want[(r[0] is not None, r[0] or 0, r[1] or "")]) for r in rows), key=str)


def test_near_duplicates(docs, none):
    df, rows = docs
    got = bagminhash.near_duplicates(df).collect()
    assert len(got) == len(rows) and bagminhash.near_duplicates(none).count() == 0
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert of[1].class_id == of[2].class_id == of[3].class_id == 1 and of[1].kept and not of[2].kept
    assert of[4].class_id == of[5].class_id == 4 and of[7].class_id == 7
    kept = bagminhash.deduplicated(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.where("doc_id = 8").collect()] == [8]
    assert sorted(r.doc_id for r in kept.where("doc_id < 6").collect()) == [1, 4]
    assert bagminhash.deduplicated(none).count() == 0


def test_large_groups_take_rounds(spark, monkeypatch):
    """Many near copies: pivots first, the rest pair by pair; the same classes as brute force."""
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4])):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        rows.append({"doc_id": i, "text": " ".join(w)})
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    want = brute_classes(rows)
    for pairs in (0, 2):
        monkeypatch.setattr(bagminhash, "PAIRS_PER_TEXT", pairs)
        assert {r.doc_id: r.class_id for r in bagminhash.near_duplicates(df).collect()} == want


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 9, 300)
    b = np.maximum(0, a + rng.integers(-3, 4, 300))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    found = []
    for _ in range(40):
        v = rng.integers(0, 2**63, 300).astype(np.uint64)
        text, value, weight = np.repeat([0, 1], 300), np.tile(v, 2), np.concatenate([a, b])
        some = weight > 0
        s = bagminhash.signatures(text[some], value[some], weight[some], 2)
        found.append((s[0] == s[1]).mean())
    assert abs(np.mean(found) - want) < 0.025


def test_bpe(docs, none):
    df, rows = docs
    got = bpe.encode_texts(df, VOCABULARY).collect()
    assert sorted((r.decoded for r in got)) == sorted(r[1] or "" for r in rows)
    assert all((len(r.ids) == 0) == (not r.decoded) for r in got)
    assert bpe.encode_texts(none, VOCABULARY).count() == 0


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(VOCABULARY), bpe.Encoder(open(VOCABULARY, "rb").read())
    rnd = random.Random(1)
    for _ in range(1500):
        text = "".join(rnd.choice([rnd.choice("ab 's\n\té中😀12    zz"), chr(rnd.randrange(32, 0x3000)), "<|endoftext|>"]) for _ in range(rnd.randrange(50)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)
    for piece in ("a" * 500, "ab" * 300):
        assert np.frombuffer(own.encode(piece), "<u4").tolist() == library.encode(piece).ids


def test_licenses(spark, docs, none):
    df, rows = docs
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[9].licenses == "MIT" and got[4].n_sentences == 0 and licenses.scan(none).count() == 0
    text = "x\n" + " ".join(licenses.SENTENCES[k] for k in ("mit_grant", "mit_keep", "mit_as_is")).replace("software", "\nsoftware") + "\n" + licenses.SENTENCES["gpl_grant"]
    found = licenses.scan(spark.createDataFrame([(1, "Head.\n" + text[2:])], "doc_id long, text string")).first()
    assert found.licenses == "MIT,GPL-3.0-or-later"
    part = licenses.scan(spark.createDataFrame([(1, licenses.SENTENCES["mit_keep"])], "doc_id long, text string")).first()
    assert part.n_sentences == 1 and part.licenses == ""


def test_mixing(docs, none):
    df, rows = docs
    got = mixing.taken_words(df).collect()
    assert len(got) == len(rows) and mixing.taken_words(none).count() == 0
    assert all(r.taken <= 3 * r.size for r in got) and all(r.taken == 0 for r in got if r.size == 0)
    assert abs(sum({r.target: r.target for r in got}.values()) - sum(r.size for r in got)) < 1
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    assert sorted(mixing.permutation(np.arange(n), n, 5)) == list(range(n))


def test_shard_counts_keep_totals():
    counts = mixing.shard_counts([1000, 10, 0, 333], 7)
    assert counts.sum(axis=0).tolist() == [1000, 10, 0, 333] and np.ptp(counts.sum(axis=1)) <= 1


def test_targets_reshare_the_excess():
    assert mixing.targets([10, 100, 1000], [5, 2, 1]) == [30, 300, 780]
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [5, 2]) == [0, 5]


def test_bytes(docs, none):
    df, rows = docs
    got = sorted(map(tuple, bwt.without_repeats(df).select("doc_id", "n_bytes", "kept").collect()), key=str)
    texts = {(r[0], r[1]): r[1] or "" for r in rows if len(r[1] or "") < 100_000}
    want = brute_bytes(texts)  # equal rows are one document
    small = [g for g in got if g[1] < 100_000]
    assert small == sorted(((r[0], len((r[1] or "").encode()), bytearray(want[r[0], r[1]][0])) for r in rows if (r[0], r[1]) in want), key=str)
    assert len(got) == len(rows) and bwt.without_repeats(none).count() == 0
    assert bwt.cleaned_documents(df).columns == df.columns and bwt.cleaned_documents(none).count() == 0


def test_large_byte_groups_are_counted_in_spark(spark, monkeypatch):
    rnd = random.Random(3)
    middle = "".join(rnd.choice("abcdef ") for _ in range(150))
    text = {}
    for i in range(40):
        side = "".join(rnd.choice("xyz ") for _ in range(300))
        near = "".join(rnd.choice("pq") for _ in range(3))
        text[i] = side[:150] + near + middle + ("t" * 60 if i % 2 else "") + side[150:]
    df = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    want = {i: (b, n) for i, (b, n) in brute_bytes(text).items()}
    for rows in (bwt.GROUP_ROWS, 2):
        monkeypatch.setattr(bwt, "GROUP_ROWS", rows)
        got = {r.doc_id: (bytes(r.kept), len(r.spans)) for r in bwt.without_repeats(df).collect()}
        assert got == want


def test_interleaves_equal_sorting():
    rng = np.random.default_rng(0)
    for _ in range(100):
        m, length, reach = int(rng.integers(1, 30)), 16, 8
        group = np.sort(rng.integers(0, 4, m))
        after = rng.integers(1, 4, (m, length)).astype(np.uint8)
        before = rng.integers(1, 4, (m, reach)).astype(np.uint8)
        for _ in range(m):
            i, j = rng.integers(0, m, 2)
            after[i], before[i] = after[j], before[j]
            if rng.random() < 0.7:
                after[i, rng.integers(0, length)] ^= 3
        order, _ = interleave.merged_order(group, after)
        keys = [(group[i], after[i].tobytes()) for i in range(m)]
        assert [keys[i] for i in order] == sorted(keys)
        row, step = interleave.repeated_offsets(group, after, before, np.zeros(m, int), np.full(m, reach), length)
        want = set()
        for t in range(reach + 1):
            same = {}
            for i in range(m):
                same.setdefault((group[i], before[i, :t].tobytes(), after[i, : length - t].tobytes()), []).append(i)
            want |= {(i, t) for v in same.values() if len(v) > 1 for i in v}
        assert set(zip(row.tolist(), step.tolist(), strict=True)) == want


def test_classifier(docs, none, labels):
    df, rows = docs
    got = neighbours.verdicts(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert neighbours.verdicts(none, labels).count() == 0
    unjudged = neighbours.verdicts(df, labels.where("false")).collect()
    assert {r.score for r in unjudged} == {1.0}
    kept = neighbours.kept_documents(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)


def test_shards(docs, none):
    df, rows = docs
    got = sharding.shard_rows(df, 4).collect()
    assert len(got) == len(rows) and sharding.shard_rows(none, 4).count() == 0
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_hot_group_is_cut(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one text', concat('text ', id)) as text")
    got = sharding.shard_rows(df, 10).groupBy("shard").agg(F.sum("size").alias("b"), F.count("slot").alias("n")).collect()
    assert len(got) == 10 and max(r.b for r in got) < 1.05 * min(r.b for r in got)


def test_stages_take_any_documents(spark, docs, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for frame in docs[0], none:
        rows = frame
        for name, stage in corpus_pipeline.STAGES:
            columns = rows.columns
            rows = stage(spark, rows, str(tmp_path))
            path = str(tmp_path / f"{name}-{id(frame)}")
            rows.write.parquet(path)
            rows = spark.read.parquet(path)
            assert name == corpus_pipeline.STAGES[-1][0] or rows.columns == columns


def test_word_blocks():
    column = pa.array(["", None, "a bc\n d", " ", "é", "a"])
    found = Words(*flat(column))
    assert found.counts().tolist() == [0, 0, 3, 0, 1, 1]
    hashes = found.hashes()
    assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == 4
    assert sliding_argmin(np.array([5 << 9, 3 << 9, 3 << 9, 9 << 9], np.uint64), 3).tolist() == [1, 1]


MIT_TEXT = """MIT License

Copyright (c) 2024 A B

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE_TEXT = """Copyright 2024 A B

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_unedited_licence_headers(spark, mark):
    rows = [(i, "".join(f"{mark}{line}\n" for line in text.splitlines())) for i, text in enumerate([MIT_TEXT, APACHE_TEXT])]
    rows += [(2, rows[0][1] + rows[1][1].replace("\n", "\r\n")), (3, "This is not\nreleased under the MIT License, nor\nwill it be.")]
    rows += [(4, "It is not released under the MIT License.")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].sentence_ids == "<mit_grant><mit_keep><mit_as_is>" and got[0].licenses == "MIT"
    assert got[1].sentence_ids == "<apache_notice_long><apache_copy><apache_as_is><apache_limits>"
    assert got[1].licenses == "Apache-2.0" and got[2].licenses == "MIT,Apache-2.0"
    assert got[3].licenses == got[4].licenses == ""


def test_small_languages_have_their_own_reference(spark, monkeypatch):
    rnd = random.Random(7)
    text = lambda stem, n: " ".join(f"{stem}{min(int(rnd.expovariate(0.01)), 2000)}" for _ in range(n))
    rows = [(i, text("word", 10_000), "en") for i in range(20)]
    rows += [(100 + i, text("слово", 900), "uk") for i in range(6)]  # enough words for a reference
    rows += [(200, text("буква", 100), "bg"), (300, text("word", 300), "uk"), (400, text("word", 300), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in divergence.quality_rules(df).collect()}
    assert len(got) == len(rows) and got[200].kept and got[200].class_distance is got[200].word_distance is None
    assert all(got[i].kept and got[i].class_distance < 0.2 for i in [*range(20), *range(100, 106)])
    assert not got[300].kept and got[400].word_distance is not None
    monkeypatch.setattr(divergence, "LEAST_SHARE", 0.5)  # now a rare language: the same from the joined table
    assert {r.doc_id: r for r in divergence.quality_rules(df).collect()} == got


def test_anchors_do_not_depend_on_the_batch():
    rng = np.random.default_rng(11)
    values = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    values[100:140] = values[100]  # ties: the first
    values[200:203] = np.uint64(1 << 40) + np.array([5, 3, 4], np.uint64)
    whole = sliding_argmin(values, 13)
    assert (values[whole] >> np.uint64(32) == [(values[i : i + 13] >> np.uint64(32)).min() for i in range(488)]).all()
    for size in (13, 14, 40, 300):
        for at in range(0, 500 - size, 7):
            own = sliding_argmin(values[at : at + size], 13) + at
            assert (own == whole[at : at + size - 12]).all()
    assert sliding_argmin(values[200:202], 2)[0] == 0 == sliding_argmin(np.append(values[200:202], values[:38]), 2)[0]


def test_equal_strings_have_equal_anchors():
    passage = long_text(21, 60)
    alone = seeds.Anchored(pa.array([passage])).extents()
    among = seeds.Anchored(pa.array([long_text(22, 3000), long_text(23, 500) + " " + passage + " " + long_text(24, 5000)])).extents()
    assert len(set(alone[4].tolist()) - set(among[4].tolist())) == 0
    data = pa.array([passage * 2])
    few, many = bwt.Anchored(data).extents(), bwt.Anchored(pa.array([long_text(25, 4000), "x" + passage * 2])).extents()
    assert set(few[4].tolist()) <= set(many[4].tolist())


def test_names_are_defined_once():
    import ast
    from pathlib import Path

    for path in Path(bwt.__file__).parent.glob("*.py"):
        names = [x.name for x in ast.parse(path.read_text()).body if isinstance(x, ast.FunctionDef | ast.ClassDef)]
        names += [t.id for x in ast.parse(path.read_text()).body if isinstance(x, ast.Assign) for t in x.targets if isinstance(t, ast.Name)]
        assert len(names) == len(set(names)), path


@pytest.mark.parametrize("one_id", [5, None])
def test_repeated_rows_spread_over_shards(spark, one_id):
    rows = [(one_id, "the same text " * 8) for _ in range(1000)] + [(10 + i, f"text {i} " * 9) for i in range(2000)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), 10)
    per = got.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert len(per) == 10 and sum(r.n for r in per) == 3000 and all(r.top == r.n - 1 for r in per)
    assert min(r.b for r in per) >= 0.95 * max(r.b for r in per)
    hot = got.where(F.col("doc_id").eqNullSafe(F.lit(one_id))).groupBy("shard").count().collect()
    assert max(r["count"] for r in hot) < 400
