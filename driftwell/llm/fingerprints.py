"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` keeps, for two bases modulo the prime 2**31 - 1, the running sums of
``code * base**i``. The difference of two entries, shifted back by the inverse power, is the hash of any
span in constant time, whatever its place; a binary search over lengths then finds the longest common
extension of two places. The arrays of a text put together from parts of others follow from theirs
without hashing its letters again.

A fingerprint is text: number of code points, hash of the whole text, and the smallest of the (mixed)
hashes of all spans of ``WINDOW`` code points; texts under twice ``SHORT`` code points also keep those of
spans of ``FINE``. Its likeness to another estimates the share of spans that both have (0 to 1), fine
spans if one of them is under ``SHORT``. Equal texts have equal fingerprints.

Defined cases: a null text is empty; two empty texts have likeness 1, an empty and another 0; a
text shorter than a span has none; rows with one ``doc_id`` follow each other by text hash, rows without
``doc_id`` come last; a single document is its own neighbour; columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.blocks import mix64
from driftwell.llm.table import texts

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 69_069_069)
WINDOW = 24
FINE = 4
SHORT = 96
KEPT = 64
DIGITS = 10
ROWS_PER_BUCKET = 10_000
MAX_BUCKETS = 20_000  # limits the tasks, not the rows

U = np.uint64
_P, _S = U(PRIME), U(31)


def _mod(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _S)
    x = (x & _P) + (x >> _S)
    return np.where(x >= _P, x - _P, x)


class Powers:
    """Powers of a base and of its inverse, made longer as longer texts come."""

    def __init__(self, base: int):
        self.base = (base, pow(base, -1, PRIME))
        self.tables = [np.ones(1, U), np.ones(1, U)]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0]) <= n:
            for k in (0, 1):
                t = self.tables[k]
                self.tables[k] = np.concatenate([t, _mod(t * U(pow(self.base[k], len(t), PRIME)))])
        return self.tables[0], self.tables[1]


_POWERS = [Powers(b) for b in BASES]


class PrefixHashes:
    def __init__(self, sums: list[np.ndarray]):
        self.sums = sums
        self.n = len(sums[0]) - 1

    @classmethod
    def of(cls, text: str) -> PrefixHashes:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(U) + U(1)
        sums = []
        for powers in _POWERS:
            out = np.zeros(len(codes) + 1, U)
            np.cumsum(_mod(codes * powers.get(len(codes))[0][: len(codes)]), out=out[1:])
            sums.append(_mod(out))
        return cls(sums)

    def spliced(self, keep: int, other: PrefixHashes, take: int) -> PrefixHashes:
        """The arrays of ``self[:keep] + other[:take]``, from the arrays of both."""
        sums = []
        for powers, a, b in zip(_POWERS, self.sums, other.sums, strict=True):
            shift = powers.get(keep)[0][keep]
            sums.append(np.concatenate([a[: keep + 1], _mod(a[keep] + _mod(b[1 : take + 1] * shift))]))
        return PrefixHashes(sums)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes (62 bits) of the spans [start, end)."""
        out = np.zeros(len(start), U)
        for powers, a in zip(_POWERS, self.sums, strict=True):
            back = powers.get(self.n)[1]
            out = (out << _S) | _mod((a[end] + _P - a[start]) * back[start])
        return out

    def windows(self, size: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Mixed hashes of the spans of ``size`` that start at ``first`` to ``last`` (excluded)."""
        last = self.n - size + 1 if last is None else last
        out = np.zeros(max(0, last - first), U)
        if last <= first:
            return out
        for powers, a in zip(_POWERS, self.sums, strict=True):
            back = powers.get(self.n)[1][first:last]
            out = (out << _S) | _mod((a[first + size : last + size] + _P - a[first:last]) * back)
        return mix64(out)

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def equal(self, i: int, other: PrefixHashes, j: int, length: int) -> bool:
        """Whether ``self[i:i+length] == other[j:j+length]``, in constant time."""
        for powers, a, b in zip(_POWERS, self.sums, other.sums, strict=True):
            forward = powers.get(max(i, j))[0]
            x = (int(a[i + length]) - int(a[i])) * int(forward[j])
            y = (int(b[j + length]) - int(b[j])) * int(forward[i])
            if (x - y) % PRIME:
                return False
        return True

    def common_extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """The longest length for which both texts go on alike from ``i`` and ``j``, by binary search."""
        most = min(self.n - i, other.n - j)
        return bisect_right(range(1, most + 1), 0, key=lambda length: not self.equal(i, other, j, length))


def smallest(parts: list[np.ndarray], kept: int = KEPT) -> np.ndarray:
    """The ``kept`` smallest distinct values of all parts, in order."""
    few = []
    for p in parts:
        if len(p) > 4 * kept:
            low = np.unique(np.partition(p, 2 * kept)[: 2 * kept])
            p = low if len(low) >= kept else np.unique(p)
        few.append(p)
    return np.unique(np.concatenate(few))[:kept] if few else np.empty(0, U)


def printed(hashes: PrefixHashes, parts: list[np.ndarray]) -> str:
    """The fingerprint of a text, given its prefix hashes and window hashes (in parts)."""
    whole = hashes.span(0, hashes.n)
    sketches = [smallest(parts), smallest([hashes.windows(FINE)] if hashes.n < 2 * SHORT else [])]
    digits = ["".join([f"{v:016x}"[:DIGITS] for v in sketch.tolist()]) for sketch in sketches]
    return f"{hashes.n}:{whole:016x}:{digits[0]}:{digits[1]}"


def likeness(a: str, b: str) -> float:
    """Estimated share of spans that two fingerprinted texts have in common."""
    if a == b:
        return 1.0
    (n, _, *left), (m, _, *right) = a.split(":"), b.split(":")
    fine = min(int(n), int(m)) < SHORT and max(int(n), int(m)) < 2 * SHORT
    x, y = ({s[i : i + DIGITS] for i in range(0, len(s), DIGITS)} for s in (left[fine], right[fine]))
    if not x or not y:
        return 0.0
    low = sorted(x | y)[:KEPT]  # the smallest of the union: a fair sample of it
    return sum(v in x and v in y for v in low) / len(low)


class Document:
    """A text with its prefix hashes, window hashes and fingerprint."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.n = doc_id, text, len(text)
        self.hashes = PrefixHashes.of(text)
        self.windows = self.hashes.windows(WINDOW)
        self.fingerprint = printed(self.hashes, [self.windows])

    def compared(self, after: Document) -> tuple:
        """The row of this document, whose last third is replaced by the start of the next one."""
        cut = self.n // 3
        keep, take = self.n - cut, min(cut, after.n)
        hashes = self.hashes.spliced(keep, after.hashes, take)
        joint = hashes.windows(WINDOW, max(0, keep - WINDOW + 1), max(0, min(keep, hashes.n - WINDOW + 1)))
        parts = [self.windows[: max(0, keep - WINDOW + 1)], joint, after.windows[: max(0, take - WINDOW + 1)]]
        edited = printed(hashes, parts)
        return (
            self.doc_id,
            self.n,
            hashlib.sha256((self.text[:keep] + after.text[:take]).encode()).hexdigest(),
            self.fingerprint,
            edited,
            likeness(self.fingerprint, edited),
            likeness(self.fingerprint, after.fingerprint),
            self.hashes.common_extension(0, hashes, 0),
            self.hashes.common_extension(0, after.hashes, 0),
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars`` and ``fingerprint`` of every text. No shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            got = [Document(None, t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([d.n for d in got], pa.int64()), pa.array([d.fingerprint for d in got])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def in_id_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text, tail``: partitions that hold descending runs of ids, each ended by a copy (``tail``) of
    the row that comes next in the whole order; the first row follows the last.

    One shuffle of the texts. Split points come from a narrow pass over the ids; the rows that begin a
    bucket, at most one id for each, are the only ones that are copied.
    """
    spark = docs.sparkSession
    keyed = texts(docs).withColumn("o", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    rows = keyed.count()
    n = int(min(MAX_BUCKETS, max(1, rows // ROWS_PER_BUCKET, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    shares = F.lit([i / n for i in range(1, n)] or [0.5])
    points = keyed.where(F.col("doc_id").isNotNull()).agg(F.percentile_approx("o", shares, 20 * n)).first()[0] or []
    splits = [float("-inf"), *(sorted(set(points)) or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="o", outputCol="bucket").transform(keyed)
    bucketed = bucketed.withColumn("bucket", F.col("bucket").cast("int")).drop("o")
    heads = sorted(map(tuple, bucketed.groupBy("bucket").agg(F.max("doc_id")).collect()))  # one row per bucket
    if not heads:
        return bucketed.select("doc_id", "text", F.lit(False).alias("tail"))
    copies = [(b, i, heads[k + 1 if k + 1 < len(heads) else 0][0]) for k, (b, i) in enumerate(heads)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    begins = F.broadcast(spark.createDataFrame(copies, f"head_bucket int, head_id {kind}, to int"))
    places = F.when(F.col("to").isNull(), F.array("bucket")).otherwise(F.array("bucket", "to"))
    return (
        bucketed.join(
            begins, (F.col("bucket") == F.col("head_bucket")) & F.col("doc_id").eqNullSafe(F.col("head_id")), "left"
        )
        .select("doc_id", "text", "th", F.posexplode(places).alias("copy", "place"))
        .repartitionById(len(splits) - 1, F.col("place"))
        .sortWithinPartitions("copy", F.desc_nulls_last("doc_id"), "th")
        .select("doc_id", "text", (F.col("copy") > 0).alias("tail"))
    )


NEIGHBOURS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_edited long, common_next long"
)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Every document compared with its edited text and with the next document, by descending ``doc_id``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        last, names = None, None
        for batch in batches:
            out = []
            for doc_id, text, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tail and last is None:
                    break
                here = Document(doc_id, text)
                if last is not None:
                    out.append(last.compared(here))
                last = None if tail else here
                if tail:
                    break
            if out:
                names = names or ["doc_id", *[c.split()[0] for c in NEIGHBOURS.split(", ")]]
                columns = [pa.array(c) for c in zip(*out, strict=True)]
                columns[0] = columns[0].cast(batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_id_order(docs).mapInArrow(run, f"doc_id {kind}, {NEIGHBOURS}")
