"""Runs by recompression against brute force, and the defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from driftwell.llm.recompression import Grammar, runs, word_runs
from driftwell.llm.registered import LLM_QUERIES


def brute(s):
    found = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def kept(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(rnd):
    n, k = rnd.randrange(120), rnd.choice([1, 2, 3, 5, 30])
    text = [rnd.randrange(k) for _ in range(n)]
    if n and rnd.random() < 0.6:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange(max(1, (n - a) // 3))
        text[a:] = [text[a + i % p] for i in range(n - a)]
    return np.array(text, np.int64)


def test_runs():
    rnd = random.Random(3)
    for _ in range(150):
        texts = [some_text(rnd) for _ in range(rnd.randrange(6))]
        wanted = [(d, *r) for d, t in enumerate(texts) for r in brute(t.tolist())]
        assert list(zip(*(x.tolist() for x in runs(texts)), strict=True)) == wanted


def test_extensions():
    rnd = random.Random(4)

    def common(s, i, j):
        k = 0
        while j + k < len(s) and s[i + k] == s[j + k]:
            k += 1
        return k

    for _ in range(100):
        s = [*some_text(rnd).tolist(), 999]
        grammar = Grammar(np.array(s))
        pairs = [tuple(sorted(rnd.sample(range(len(s) + 1), 2))) for _ in range(30)]
        i, j = (np.array(x) for x in zip(*pairs, strict=True))
        back = s[::-1]
        assert grammar.extend(i, j).tolist() == [common(s, a, b) for a, b in pairs]
        assert grammar.extend_left(i, j).tolist() == [common(back, len(s) - b, len(s) - a) for a, b in pairs]


def test_levels_are_few():
    assert len(Grammar(np.append(np.zeros(1 << 16, np.int64), 1)).levels) <= 4
    period = np.resize(np.random.default_rng(1).integers(0, 900, 900), 200_000)
    assert len(Grammar(np.append(period, 999)).levels) < 50
    assert [x.tolist() for x in runs([period])] == [[0], [0], [200_000], [900]]


def test_query(spark, data_dir):
    got = {r.doc_id: tuple(r)[1:] for r in LLM_QUERIES["op12_recompression_runs"].job(spark, data_dir).collect()}
    docs = pq.read_table(f"{data_dir}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    planted = 0
    for d in docs:
        words = [w.decode() for w in (d["text"] or "").encode().split()]
        g, rest = divmod(zlib.crc32(str(d["doc_id"]).encode()), 10)
        if rest == 0 and words:
            planted += 1
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        a, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
        wanted = (len(found), a, n, q, 1000 * n // q if n else None, sha(lines), sha(kept(words, found)))
        assert got[d["doc_id"]] == wanted
    assert planted > 5


def test_cases(spark):
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(400)}" for _ in range(30_000)]
    long[5000:25_000] = [f"w{i % 1234}" for i in range(20_000)]
    texts = {1: None, 2: "", 3: " \n\t", 4: "a a a a a", 5: "a\ta\na a  a a", 6: "a b " * 6, 7: " ".join(long), 8: "x x x x x x y y y y y y"}
    rows = [*texts.items(), (7, texts[7]), (None, "z " * 9), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("runs", "collapsed", "key", "start", "n_words"):
        docs = docs.withColumn(name, F.lit(1))
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in word_runs(docs).collect()))
    wanted = []
    for i, t in rows:
        w = (t or "").split()
        wanted.append((i or 0, len(w), brute(w) if len(w) < 1000 else [(5000, 20_000, 1234)], None))
        wanted[-1] = (*wanted[-1][:3], kept(w, wanted[-1][2]))
    assert got == sorted(wanted)
    assert word_runs(docs.where("false")).count() == 0
