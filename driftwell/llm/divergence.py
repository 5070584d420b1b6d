"""Quality rules by distribution divergence.

For every language of the corpus a reference is counted over all its documents: how its characters fall
into classes, and which words make up at least ``COMMON`` of its words. A document is compared with the
reference of its language by the Jensen-Shannon distance of the two histograms (0 to 1), each only if the
document is long enough for it. A language of fewer than ``LEAST_REFERENCE`` words has no reference, and its
documents are judged by the base rule alone; no document is compared with other languages. References of languages
with at least ``LEAST_SHARE`` of all words are broadcast, at most ``1 / LEAST_SHARE + 1`` of ``1 / COMMON`` words;
those of all other languages are a table that is joined with their documents. The way does not change a result.

Defined cases: a null or empty text has no words and fails the base rule; a null or empty language is compared
with the whole corpus (and so is a language named ``*``); a very long text is one row; repeated rows give repeated results; an empty table gives an empty result; columns
other than ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.blocks import Words, constants, flat, mix64, window_hashes
from driftwell.llm.table import per_batch
from driftwell.session import pin

COMMON = 0.0025
LEAST_SHARE = 0.001
LEAST_REFERENCE = 4_000  # words of a language: its rarest common word occurs ten times
MIN_WORDS = 40
MIN_CHARS = 200
MAX_CLASS_DISTANCE = 0.28
WORD_FLOOR, WORD_NOISE = 0.16, 1.9  # short texts scatter more: the limit falls with the root of the length
LEAST_WORDS = 10
MOST_REPEATED_PCT = 20
WINDOW = 5
ALL = "*"
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
HELD_LANGUAGES = 64

# The classes of a character, by the first byte of its UTF-8 form.
CLASSES = ("lower", "upper", "digit", "space", "mark", "sign", "two", "more")
MARKS = b".,;:'\"?!()-"
SYMBOLS = b"#*$%&|<>"


def _class_table() -> np.ndarray:
    out = np.full(256, 5, np.int64)
    for first, last, kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (9, 13, 3), (32, 32, 3), (0x80, 0xBF, 8)):
        out[first : last + 1] = kind
    out[list(MARKS)] = 4
    out[0xC0:0xE0] = 6
    out[0xE0:] = 7
    return out


CLASS_OF = _class_table()
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_SALT = constants("document", 1)[0]


def sums_by_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Texts:
    """Counts of a batch of texts."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        self.n = len(self.offsets) - 1
        self.words = Words(self.data, self.offsets)
        self.n_words = self.words.counts()
        self.hashes = self.words.hashes()
        self.doc = np.repeat(np.arange(self.n), self.n_words)

    def classes(self) -> np.ndarray:
        """Characters of each class (texts x classes)."""
        doc = np.repeat(np.arange(self.n), np.diff(self.offsets))
        counts = np.bincount(doc * 9 + CLASS_OF[self.data], minlength=9 * self.n)
        return counts.reshape(self.n, 9)[:, :8]

    def word_chars(self) -> np.ndarray:
        return sums_by_text(self.words.inside & ((self.data & 0xC0) != 0x80), self.offsets)

    def symbols(self) -> np.ndarray:
        return sums_by_text(IS_SYMBOL[self.data], self.offsets)

    def repeated_lines(self) -> np.ndarray:
        out = np.zeros(self.n, np.int64)
        raw, at = self.data.tobytes(), self.offsets.tolist()
        for i in range(self.n):
            lines = [line for line in raw[at[i] : at[i + 1]].split(b"\n") if line.strip()]
            out[i] = len(lines) - len(set(lines))
        return out

    def repeated_words(self) -> np.ndarray:
        """Words inside windows of five words that the text holds more than once."""
        n = len(self.hashes) - WINDOW + 1
        covered = np.zeros(len(self.hashes), bool)
        if n > 0:
            own = np.flatnonzero(self.doc[:n] == self.doc[WINDOW - 1 :])
            keys = mix64(window_hashes(self.hashes, WINDOW, "five")[own] + self.doc[own].astype(np.uint64) * _SALT)
            order = np.argsort(keys)
            same = keys[order][1:] == keys[order][:-1]
            twice = np.zeros(len(own), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            for j in range(WINDOW):
                covered[own[twice] + j] = True
        return np.bincount(self.doc[covered], minlength=self.n)


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row's shares to the reference's; 0 for a row without counts."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / max(reference.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.where(counts.sum(axis=1) > 0, np.sqrt(np.maximum((left + right) / 2, 0)), 0.0)


def _by_language(column: pa.Array) -> tuple[list[str], np.ndarray]:
    names, of = np.unique(np.array([x or "" for x in column.to_pylist()], str), return_inverse=True)
    return names.tolist(), of


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _bucket_counts(batches):
    """``lang, bucket, n``: words by hash bucket and, after the buckets, character classes. Summed per task."""
    held: dict[str, np.ndarray] = {}

    def rows():
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            arrays = [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some])]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        texts = Texts(batch.column(0))
        names, of = _by_language(batch.column(1))
        words = np.bincount(of[texts.doc] * BUCKETS + _bucket(texts.hashes), minlength=len(names) * BUCKETS)
        classes = texts.classes()
        for k, lang in enumerate(names):
            own = held.setdefault(lang, np.zeros(BUCKETS + len(CLASSES), np.int64))
            own[:BUCKETS] += words[k * BUCKETS : (k + 1) * BUCKETS]
            own[BUCKETS:] += classes[of == k].sum(axis=0)
        if len(held) > HELD_LANGUAGES:
            yield from rows()
    yield from rows()


def _word_counts(batch: pa.RecordBatch, heavy: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """``lang, cell, n``: the words of a batch that fall into heavy buckets of their language or of all."""
    texts = Texts(batch.column(0))
    names, of = _by_language(batch.column(1))
    asked = np.zeros((len(names), BUCKETS), bool)
    for k, lang in enumerate(names):
        for name in (lang, ALL):
            asked[k, heavy.get(name, [])] = True
    own = of[texts.doc]
    place = np.flatnonzero(asked[own, _bucket(texts.hashes)])
    if not len(place):
        return None
    keys = mix64(texts.hashes[place] + own[place].astype(np.uint64) * _SALT)
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    place = place[first]
    start, end = texts.words.start[place].tolist(), texts.words.end[place].tolist()
    cells = [texts.data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)]
    arrays = [pa.array([names[i] for i in own[place]], pa.string()), pa.array(cells, pa.string()), pa.array(counts)]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "cell", "n"])


def _carried_word_counts(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The same for documents that bring the heavy buckets of their language along."""
    return _word_counts(batch, dict(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)))


def _rare_references(rows: DataFrame, counted: DataFrame, rare: DataFrame) -> DataFrame:
    """``lang, classes, common, words`` of each language of ``rare``, one row each, counted as the others are."""
    n, bucket = F.col("n"), F.col("bucket")
    own = counted.join(rare, "lang").groupBy("lang", "words", "bucket").agg(F.sum("n").alias("n"))
    heavy = F.when((bucket < BUCKETS) & (n >= COMMON * F.col("words")), bucket)
    kinds = F.when(bucket >= BUCKETS, F.struct((bucket - BUCKETS).alias("kind"), "n"))
    sketch = own.groupBy("lang", "words").agg(F.collect_list(heavy).alias("heavy"), F.collect_list(kinds).alias("classes"))
    sketch = pin(sketch, "sketch")
    spelled = rows.join(sketch.select("lang", "heavy"), "lang").select("text", "lang", "heavy")
    spelled = spelled.mapInArrow(per_batch(lambda: _carried_word_counts), "lang string, cell string, n long")
    spelled = spelled.groupBy("lang", "cell").agg(F.sum("n").alias("n")).join(rare, "lang")
    common = spelled.where(n >= COMMON * F.col("words")).groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("common"))
    return pin(sketch.join(common, "lang", "left").select("lang", "classes", "common", "words"), "rare")


def references(docs: DataFrame) -> tuple[dict[str, tuple[np.ndarray, dict[str, int], int]], DataFrame]:
    """Class counts, common words and number of words of each language, and of the whole corpus (``*``):
    a dictionary for languages of at least ``LEAST_SHARE`` and the corpus, a table for the others.

    Exact, from two passes over all documents. The first sums words by hash bucket: a common word makes its
    bucket at least as heavy, so there are at most ``1 / COMMON`` heavy buckets per language. The second
    counts the words of heavy buckets one by one. What comes to the driver is bounded by ``COMMON`` and
    ``LEAST_SHARE``.
    """
    rows = docs.select("text", "lang")
    counted = pin(rows.mapInArrow(_bucket_counts, "lang string, bucket int, n long"), "buckets")
    is_word = F.col("bucket") < BUCKETS
    sizes = pin(counted.where(is_word).groupBy("lang").agg(F.sum("n").alias("words")), "sizes")
    total = sizes.agg(F.sum("words")).first()[0] or 0
    sized = sizes.where(~F.col("lang").isin("", ALL) & (F.col("words") >= LEAST_REFERENCE))
    large = sized.where(F.col("words") >= LEAST_SHARE * total)
    rare = _rare_references(rows, counted, sized.where(F.col("words") < LEAST_SHARE * total))
    pooled = counted.groupBy("bucket").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "bucket", "n")
    own = counted.join(F.broadcast(large.select("lang")), "lang").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    words = F.broadcast(large.union(large.sparkSession.createDataFrame([(ALL, int(total))], "lang string, words long")))
    cells = own.unionByName(pooled).join(words, "lang").where(~is_word | (F.col("n") >= COMMON * F.col("words")))
    out: dict[str, tuple[np.ndarray, dict[str, int], int]] = {}
    heavy: dict[str, list[int]] = {}
    for r in cells.collect():
        classes, _, _ = out.setdefault(r.lang, (np.zeros(len(CLASSES)), {}, r.words))
        if r.bucket < BUCKETS:
            heavy.setdefault(r.lang, []).append(r.bucket)
        else:
            classes[r.bucket - BUCKETS] = r.n
    shared = docs.sparkSession.sparkContext.broadcast({k: np.array(sorted(v)) for k, v in heavy.items()})
    spelled = rows.mapInArrow(
        per_batch(lambda: lambda batch: _word_counts(batch, shared.value)), "lang string, cell string, n long"
    )
    spelled = pin(spelled.groupBy("lang", "cell").agg(F.sum("n").alias("n")), "words")
    pooled = spelled.groupBy("cell").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "cell", "n")
    common = spelled.unionByName(pooled).join(words, "lang").where(F.col("n") >= COMMON * F.col("words"))
    for r in common.collect():
        out[r.lang][1][r.cell] = r.n
    return out, rare


class Reference:
    """One language: class counts, the hashes of its common words in order, and their counts with the rest."""

    def __init__(self, classes: np.ndarray, common: dict[str, int], words: int):
        self.classes = classes
        names = sorted(common)
        hashes = Texts(pa.array(names, pa.string())).hashes
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        counts = np.array([common[w] for w in names], float)[order]
        self.words = np.append(counts, words - counts.sum())

    def histogram(self, hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        k = len(self.hashes)
        if k == 0:
            return np.bincount(row, minlength=rows).reshape(rows, 1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), k - 1)
        cell = np.where(self.hashes[at] == hashes, at, k)
        return np.bincount(row * (k + 1) + cell, minlength=rows * (k + 1)).reshape(rows, k + 1)


RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, class_distance double, word_distance double"
)


def _carried(batch: pa.RecordBatch) -> dict[str, Reference]:
    """References that documents bring along, by language."""
    first = {lang: i for i, lang in enumerate(batch.column(2).to_pylist())}
    out = {}
    for lang, i in first.items():
        classes = np.zeros(len(CLASSES))
        for x in batch.column(3)[i].as_py():
            classes[x["kind"]] = x["n"]
        common = {x["cell"]: x["n"] for x in batch.column(4)[i].as_py() or ()}
        out[lang] = Reference(classes, common, batch.column(5)[i].as_py())
    return out


def _judged(batch: pa.RecordBatch, found: dict[str, Reference]) -> pa.RecordBatch:
    t = Texts(batch.column(1))
    lang = np.array([x if x else ALL for x in batch.column(2).to_pylist()], object)
    classes = t.classes()
    chars = classes.sum(axis=1)
    by_class, by_word = np.zeros(t.n), np.zeros(t.n)
    alone = np.ones(t.n, bool)
    for name in set(lang.tolist()) & set(found):
        mine = np.flatnonzero(lang == name)
        alone[mine] = False
        row = np.full(t.n, -1)
        row[mine] = np.arange(len(mine))
        own = row[t.doc] >= 0
        reference = found[name]
        by_class[mine] = distance(classes[mine], reference.classes)
        counts = reference.histogram(t.hashes[own], row[t.doc[own]], len(mine))
        by_word[mine] = distance(counts, reference.words)
    by_class, by_word = by_class.round(4), by_word.round(4)
    repeated = t.repeated_words()
    failed = (t.n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PCT * t.n_words)
    no_class, no_word = alone | (chars < MIN_CHARS), alone | (t.n_words < MIN_WORDS)
    most = WORD_FLOOR + WORD_NOISE / np.sqrt(np.maximum(t.n_words, 1))
    odd = (~no_class & (by_class > MAX_CLASS_DISTANCE)) | (~no_word & (by_word > most))
    columns = [t.n_words, t.word_chars(), t.symbols(), t.repeated_lines(), repeated, failed, ~failed & ~odd]
    arrays = [batch.column(0), *map(pa.array, columns)]
    arrays += [pa.array(by_class, mask=no_class), pa.array(by_word, mask=no_word)]
    names = ["doc_id", *[c.split()[0] for c in RULES.split(", ")]]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts and verdict for every document; distances are rounded to 4 places, null where the
    document is too short for them or its language has no reference."""
    large, rare = references(docs)
    shared = docs.sparkSession.sparkContext.broadcast(large)
    layout = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RULES}"

    def make():
        found = {lang: Reference(*r) for lang, r in shared.value.items()}
        return lambda batch: _judged(batch, found)

    rows = docs.select("doc_id", "text", "lang")
    others = rows.join(rare.select("lang"), "lang", "left_anti").select("doc_id", "text", "lang")
    own = rows.join(rare, "lang").select("doc_id", "text", "lang", "classes", "common", "words")
    judged = own.mapInArrow(per_batch(lambda: lambda batch: _judged(batch, _carried(batch))), layout)
    return others.mapInArrow(per_batch(make), layout).unionByName(judged)
