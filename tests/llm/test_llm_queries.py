"""Registered operators against their SQL or a brute-force version, on the smallest tables."""

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
from oracle import compare, connect
from tokenizers import Tokenizer

import corpus_pipeline
from driftwell.llm.mixing import targets
from driftwell.llm.registered import LLM_QUERIES

WITH_SQL = sorted(n for n, q in LLM_QUERIES.items() if q.sql)


def words(text):
    return regex.findall(r"[^\x20\x09-\x0D]+", text)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(data_dir):
    return pq.read_table(f"{data_dir}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(name, spark, con, data_dir):
    verdict, _ = compare(con, LLM_QUERIES[name], spark, data_dir)
    assert verdict.startswith("ok ("), verdict


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


def run(spark, data_dir, name):
    return LLM_QUERIES[name].job(spark, data_dir).collect()


def test_fingerprints(spark, data_dir, docs):
    got = {r.doc_id: r for r in run(spark, data_dir, "op2_prefix_hash_fingerprints")}
    assert len(got) == len(docs)
    text = {d["doc_id"]: d["text"] for d in docs}
    ids = sorted(text, reverse=True)
    prints = {}
    for k, i in enumerate(ids):
        own, other, r = text[i], text[ids[(k + 1) % len(ids)]], got[i]
        cut = len(own) // 3
        edited = own[: len(own) - cut] + other[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(own), sha(edited))
        assert r.common_next == len(os.path.commonprefix([own, other]))
        assert r.common_edited == len(os.path.commonprefix([own, edited]))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert prints.setdefault(own, r.fingerprint) == r.fingerprint
        if len(own) > 300:
            assert r.near_edited > 0.2
    assert len(set(prints.values())) == len(prints)


def brute_classes(docs):
    bags = {}
    for d in docs:
        w = words(d["text"])
        bags[d["doc_id"]] = Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    sizes = {i: sum(bags[i].values()) for i in ids}
    for n, x in enumerate(ids):
        for y in ids[n + 1 :]:
            if 5 * min(sizes[x], sizes[y]) < 4 * max(sizes[x], sizes[y]) or not sizes[x]:
                continue
            low = sum((bags[x] & bags[y]).values())
            if 5 * low >= 4 * (sizes[x] + sizes[y] - low):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: root(i) for i in ids}


def test_near_duplicates(spark, data_dir, docs):
    got = run(spark, data_dir, "op4_bagminhash")
    assert {r.doc_id: r.class_id for r in got} == brute_classes(docs)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})


def test_bpe(spark, data_dir, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in run(spark, data_dir, "op5_bpe_forced_boundaries")}
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        assert got[d["doc_id"]] == (len(ids), sha(packed), sha(library.decode(ids, skip_special_tokens=False)))


def test_mix(spark, data_dir, docs):
    got = {r.doc_id: r for r in run(spark, data_dir, "op7_multinomial_block_mix")}
    again = {r.doc_id: r for r in run(spark, data_dir, "op7_multinomial_block_mix")}
    assert got == again
    size, taken = Counter(), Counter()
    for d in docs:
        size[d["source"]] += len(words(d["text"]))
        taken[d["source"]] += got[d["doc_id"]].taken
    names = sorted(size)
    want = dict(zip(names, targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    assert abs(sum(want.values()) - sum(size.values())) < 1e-6
    for d in docs:
        r = got[d["doc_id"]]
        assert r.size == len(words(d["text"])) and r.source_size == size[d["source"]]
        assert abs(r.target - want[d["source"]]) < 1e-6 and r.taken <= 3 * r.size
    # half a block of rounding, and a last block that may be short
    assert all(abs(taken[s] - want[s]) < 48 for s in names)


def test_classifier(spark, data_dir, docs):
    got = {r.doc_id: r for r in run(spark, data_dir, "op9_neighbour_votes")}
    assert set(got) == {d["doc_id"] for d in docs}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{data_dir}/labels.parquet").to_pylist()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i in labels if got[i].held_out]
    assert np.mean([got[i].predicted == labels[i] for i in held]) > 0.85


def test_shards(spark, data_dir, docs):
    got = run(spark, data_dir, "op10_vector_bin_packing")
    by_id = {r.doc_id: r for r in got}
    loads, slots, of = Counter(), {}, {}
    for d in docs:
        r, raw = by_id[d["doc_id"]], d["text"].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "bytes") and r.grown_shard is None
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        of.setdefault(raw, []).append(r)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    for group in of.values():  # a group is only cut if it exceeds a shard's share
        tokens, total = sum(r.tokens for r in group), sum(r.tokens for r in got)
        fits = sum(r.size for r in group) * 40 <= sum(loads.values()) and len(group) * 40 <= len(got) and tokens * 40 <= total
        assert not fits or len({r.shard for r in group}) == 1
    largest = max(r.size for r in got)
    assert max(loads.values()) <= sum(loads.values()) / 40 + largest


def test_pipeline(spark, data_dir, docs):
    """Each stage by brute force on what the one before kept."""
    from driftwell.session import pin

    frame = spark.read.parquet(f"{data_dir}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in frame.collect()]
        out = stage(spark, frame, data_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == frame.columns
        frame = pin(out, "stage")
        kept[name] = [r.asDict() for r in frame.collect()]
        if name.startswith("quality"):
            votes = {r.doc_id for r in run(spark, data_dir, "op9_neighbour_votes") if r.predicted}
            assert {r["doc_id"] for r in kept[name]} == votes
        elif name.startswith("MinHash"):
            classes = brute_classes(before)
            assert sorted(r["doc_id"] for r in kept[name]) == sorted(set(classes.values()))
        elif name.startswith("suffix"):
            want = brute_bytes({r["doc_id"]: r["text"] for r in before})
            want = {i: b.decode("utf-8", "ignore") for i, (b, _) in want.items()}
            assert {r["doc_id"]: r["text"] for r in kept[name]} == {i: t for i, t in want.items() if t}
        elif name.startswith("mixing"):
            total = sum(len(words(r["text"])) for r in before)
            assert abs(sum(len(words(r["text"])) for r in kept[name]) - total) < 48 * 20
            text = {r["doc_id"]: r["text"] for r in before}
            for r in kept[name]:
                own = text[r["doc_id"]]
                assert r["text"] == own or all(part in own for part in r["text"].split("\n"))
        else:
            want = Counter((r["doc_id"], len(library.encode(r["text"]).ids)) for r in before)
            assert Counter((r["doc_id"], r["n_tokens"]) for r in kept[name]) == want


def brute_bytes(text, length=200):
    """What stays of each text, and how many runs went."""
    raw = {i: t.encode() for i, t in text.items()}
    seen = Counter(b[j : j + length] for b in raw.values() for j in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out[i] = bytes(c for c, g in zip(b, gone, strict=True) if not g), runs
    return out
