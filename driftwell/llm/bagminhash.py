"""Near-duplicates by BagMinHash over multisets of five-word shingles.

A shingle that occurs ``c`` times has weight ``c``. Its weight axis is discretised in unit levels, and the
levels are grouped in intervals [0,1), [1,2), [2,4), [4,8), ...: on each interval runs a Poisson process
whose rate is the interval's length. A point is thinned by its level: it counts if the level lies under
the weight. Points come in ascending order, each picks one of ``SIGNATURE`` components at random, and a
component keeps the first point it sees; an interval is left as soon as its next point is beyond the
largest kept one. So two texts agree in a component with probability equal to their weighted Jaccard
similarity.

Signatures are cut into bands; texts that share a band are candidates. Two bounds exclude pairs without
loss: a pair's overlap is at most the smaller total weight, and at most the smaller weight of what a text
shares with any other candidate (``common``, counted over all candidates). A text whose own bound falls
short even for a partner of its size is weak; two weak texts are never similar. Of the other pairs, those
whose signatures agree in less than ``LEAST_AGREE`` of ``SIGNATURE`` components (five and a half standard
deviations below four fifths) are out, the rest is verified on the whole multisets (sum of minima to sum of
maxima, ``SIMILAR`` or more).

Links make classes. As long as the pairs of different classes in all buckets outnumber the texts
``PAIRS_PER_TEXT`` times and rounds halve them, they are not listed: a round compares one pivot
of each bucket, not a weak one, with its members in other classes, and buckets whose members have come into
one class are done. Then all pairs that are left are looked at in blocks: the members of a bucket are dealt to
blocks of about ``BLOCK`` by hash, two blocks at a time meet in a task with their texts, and only links leave
it. A pair is taken up in the first band that it shares. So no link between candidates is lost, and no list of
pairs is ever made.

Equal texts are one node from the start. Defined cases: a null text is empty; texts without words are
linked to equal texts only; a text of one to four words is one shingle; repeated rows are in one class;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.blocks import Words, constants, flat, mix64, window_hashes
from driftwell.llm.table import per_batch
from driftwell.session import pin

SHINGLE = 5
SIMILAR = (4, 5)  # four fifths
BANDS, ROWS = 24, 5
SIGNATURE = BANDS * ROWS
LEAST_AGREE = 72
NIBBLES = 16  # of a word of the mark
MARK = -(-SIGNATURE // NIBBLES)
MAX_ROUNDS = 12
PAIRS_PER_TEXT = 2
BLOCK = 64
PAIRS_AT_ONCE = 2000
ROWS_PER_FILE = 500_000

U = np.uint64
_SHORT = constants("short shingle", SHINGLE)
_TEXT = constants("text of batch", 1)[0]
_BAND = constants("band", SIGNATURE).reshape(BANDS, ROWS)
_STEP, _NODE = constants("points", 2)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct shingles of each text: text index, hash, count; and the number of texts."""
    data, offsets = flat(column)
    words = Words(data, offsets)
    n, hashes, counts = len(offsets) - 1, words.hashes(), words.counts()
    doc = np.repeat(np.arange(n), counts)
    runs = window_hashes(hashes, SHINGLE, "shingle")
    own = np.flatnonzero(doc[: len(runs)] == doc[SHINGLE - 1 :]) if len(runs) else np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    few = np.zeros(len(short), U)
    for j in range(SHINGLE - 1):
        has = counts[short] > j
        few[has] += hashes[words.first[short[has]] + j] * _SHORT[j]
    text = np.concatenate([doc[own], short])
    value = np.concatenate([runs[own], mix64(few + counts[short].astype(U))])
    _, first, times = np.unique(mix64(value + text.astype(U) * _TEXT), return_index=True, return_counts=True)
    return text[first], value[first], times, n


def signatures(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash signatures (n x SIGNATURE) of weighted elements; texts without elements have none (0)."""
    highest = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)  # intervals 0 .. highest
    which = np.repeat(np.arange(len(text)), highest + 1)
    interval = np.arange(len(which)) - np.repeat(np.cumsum(highest + 1) - highest - 1, highest + 1)
    text, value, weight = text[which], value[which], weight[which]
    base = np.where(interval > 0, 1 << np.maximum(interval - 1, 0), 0)
    width = np.maximum(base, 1)
    seed = mix64(value + interval.astype(U) * _NODE)
    at = np.zeros(len(text))
    kept = np.full(n * SIGNATURE, np.inf)
    winner = np.zeros(n * SIGNATURE, U)
    limit = np.full(n, np.inf)
    step = 0
    while len(text):
        step += 1
        gap = mix64(seed + U(step * int(_STEP) % (1 << 64)))
        at = at - np.log(((gap >> U(11)).astype(float) + 0.5) / (1 << 53)) / width
        go = at < limit[text]
        if not go.all():
            text, weight, base, width, seed, at, gap = (x[go] for x in (text, weight, base, width, seed, at, gap))
        pick = mix64(gap ^ _NODE)
        level = base + ((pick >> U(32)).astype(np.int64) & (width - 1))
        slot = text * SIGNATURE + (pick & U(0xFFFFFFFF)).astype(np.int64) % SIGNATURE
        hit = (level < weight) & (at < kept[slot])
        np.minimum.at(kept, slot[hit], at[hit])
        won = np.flatnonzero(hit)[at[hit] == kept[slot[hit]]]
        winner[slot[won]] = pick[won]
        busy = np.unique(text) if step > 4 else np.arange(n)
        limit[busy] = kept.reshape(n, SIGNATURE)[busy].max(axis=1)
    return winner.reshape(n, SIGNATURE)


def _band_rows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Rows of the different texts of a batch: copies are signed once."""
    names = np.stack([batch.column(0).field(c).to_numpy() for c in ("a", "b")], axis=1)
    once = np.unique(names, axis=0, return_index=True)[1]
    if len(once) < len(names):
        batch = batch.take(pa.array(np.sort(once)))
    text, value, weight, n = shingles(batch.column(1))
    some = np.unique(text)
    if not len(some):
        return None
    signed = signatures(text, value, weight, n)[some]
    buckets = np.stack(
        [mix64((signed[:, b * ROWS : (b + 1) * ROWS] * _BAND[b]).sum(axis=1) + U(b)) for b in range(BANDS)], axis=1
    )
    node = batch.column(0).take(pa.array(np.repeat(some, BANDS)))
    first = np.arange(len(some) * BANDS) % BANDS > 0  # a text's first row carries what is said of the text
    low = np.zeros((len(some), MARK * NIBBLES), U)
    low[:, :SIGNATURE] = signed & U(15)
    shifts = U(4) * np.arange(NIBBLES, dtype=U)
    marks = (low.reshape(len(some), MARK, NIBBLES) << shifts).sum(axis=2, dtype=U).view(np.int64)
    total = np.bincount(text, weights=weight, minlength=n)[some].astype(np.int64)
    lists = lambda x: pa.array(list(x), pa.list_(pa.int64())).take(
        pa.array(np.repeat(np.arange(len(some)), BANDS), mask=first)
    )
    flat_buckets = buckets.view(np.int64)
    arrays = [node, pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(some))), pa.array(flat_buckets.ravel())]
    arrays += [lists(marks), lists(flat_buckets), pa.array(np.repeat(total, BANDS), mask=first)]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "band", "bucket", "mark", "bands", "total"])


def similar(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which pairs of texts have a weighted Jaccard similarity of four fifths or more.

    A text that stands in many pairs of a batch is cut into shingles once."""
    n = len(left)
    named = pa.chunked_array([left, right]).combine_chunks().dictionary_encode()
    text, value, weight, kinds = shingles(named.dictionary)
    order = np.argsort(text, kind="stable")
    value, weight = value[order], weight[order]
    count = np.bincount(text, minlength=kinds)
    begin = np.concatenate([[0], np.cumsum(count)])
    of = named.indices.to_numpy()
    size = count[of]
    row = np.repeat(np.arange(2 * n), size)
    at = begin[of][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    pair = row % n
    _, first, place = np.unique(mix64(value[at] + pair.astype(U) * _TEXT), return_index=True, return_inverse=True)
    weights = np.zeros((2, len(first)), np.int64)
    weights[row // n, place] = weight[at]
    low = np.bincount(pair[first], weights=weights.min(axis=0), minlength=n)
    high = np.bincount(pair[first], weights=weights.max(axis=0), minlength=n)
    return (SIMILAR[1] * low >= SIMILAR[0] * high) & (high > 0)


NODE = "struct<a:bigint,b:bigint>"


def node(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), node(text).alias("node"))


def gathered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, then in as few files as its rows need: Spark sees the true size of a small table,
    and steps that follow do not open a file for each task that wrote it."""
    out = pin(df, name)
    return pin(out.coalesce(max(1, -(-out.count() // ROWS_PER_FILE))), name)


def _stars(batches):
    """The links of a task, shortened: each node linked with the smallest one that it reaches in this task."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    ends = [np.stack([table.column(c).combine_chunks().field(k).to_numpy() for k in ("a", "b")], axis=1) for c in ("x", "y")]
    nodes, place = np.unique(np.concatenate(ends), axis=0, return_inverse=True)  # in the order of nodes
    x, y = place.reshape(2, -1)
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        now = low.copy()
        for end in (low[x], low[y], x, y):
            np.minimum.at(now, end, least)
        now = now[now]
        if (now == low).all():
            break
        low = now
    far = np.flatnonzero(low != np.arange(len(nodes)))
    both = [pa.StructArray.from_arrays([pa.array(nodes[i, 0]), pa.array(nodes[i, 1])], ["a", "b"]) for i in (far, low[far])]
    yield pa.RecordBatch.from_arrays(both, names=["x", "y"])


def components(links: DataFrame) -> DataFrame:
    """``node, label``: smallest node of each connected component of ``links`` (x, y).

    Links are gathered in files of ``ROWS_PER_FILE`` and shortened in each; what spans files is found by rounds in
    which every node takes the smallest label around it, and the label of its label."""
    links = gathered(links.select("x", "y").where("x <> y").distinct(), "links")
    links = links.mapInArrow(_stars, f"x {NODE}, y {NODE}")
    both = gathered(links.union(links.select("y", "x")).distinct(), "links")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("label"))
    labels = gathered(labels, "labels")
    while True:
        nearby = both.join(labels, both.y == labels.node).groupBy("x").agg(F.min("label").alias("low"))
        low = labels.join(nearby, labels.node == nearby.x).select("node", F.least("label", "low").alias("mid"), "label")
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        # the label of a label is at least as small
        now = low.join(jump, "mid").select("node", F.least("mid", "far").alias("label"), F.col("label").alias("was"))
        now = gathered(now, "labels")
        labels = now.select("node", "label")
        if now.where("label <> was").isEmpty():
            return labels


def verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (x, y, with labels lx, ly) whose texts are similar enough."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = pa.array(similar(batch.column(4), batch.column(5)))
        return batch.select(["x", "y", "lx", "ly"]).filter(keep)

    left = known.select(F.col("node").alias("x"), F.col("text").alias("left"))
    right = known.select(F.col("node").alias("y"), F.col("text").alias("right"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", "lx", "ly", "left", "right")
    return both.mapInArrow(per_batch(lambda: judge), f"x {NODE}, y {NODE}, lx {NODE}, ly {NODE}")


def _agree(x: str, y: str) -> Column:
    """Components in which two marks agree: the groups of four bits without a difference."""
    ones = F.lit(0x1111111111111111)
    differ = F.lit(0)
    for i in range(MARK):
        odd = F.col(f"{x}.mark")[i].bitwiseXOR(F.col(f"{y}.mark")[i])
        for step in (1, 2):
            odd = odd.bitwiseOR(F.shiftrightunsigned(odd, step))
        differ = differ + F.bit_count(odd.bitwiseAND(ones))
    return F.lit(SIGNATURE) - differ


def _shingle_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    text, value, weight, _ = shingles(batch.column(1))
    arrays = [batch.column(0).take(pa.array(text)), pa.array(value.view(np.int64)), pa.array(weight)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "shingle", "weight"])


def _common(known: DataFrame) -> DataFrame:
    """``a, common``: weight of the shingles that a text shares with another one of ``known``."""
    rows = known.select("node.a", "text").mapInArrow(per_batch(lambda: _shingle_rows), "a long, shingle long, weight long")
    rows = rows.repartition("shingle")  # one exchange serves both sides
    held = rows.groupBy("shingle").agg(F.min("a").alias("lo"), F.max("a").alias("hi")).where("lo <> hi")
    return rows.join(held.select("shingle"), "shingle", "left_semi").groupBy("a").agg(F.sum("weight").alias("common"))


def _room() -> Column:
    """Four times a partner's total weight may be up to this."""
    return F.col("common") * (SIMILAR[0] + SIMILAR[1]) - SIMILAR[0] * F.col("total")


def _strong() -> Column:
    """There is room for a partner of the text's own weight."""
    return SIMILAR[0] * F.col("total") <= F.col("room")


def _open(members: DataFrame) -> DataFrame:
    """Memberships that may still bring a new link: the bucket holds several classes and, for a weak text,
    a strong one within its room."""
    seen = members.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.when(_strong(), F.col("total"))).alias("least")
    )
    seen = seen.where("lo <> hi and least is not null").select("bucket", "least")
    return members.join(seen, "bucket").where(_strong() | (SIMILAR[0] * F.col("least") <= F.col("room"))).drop("least")


def _pivots(members: DataFrame, step: int) -> DataFrame:
    """Pairs of different classes, with their labels: those of one pivot per bucket."""
    text = F.struct("node", "label", "total", "room", "mark")
    right = members.select(F.col("bucket").alias("other"), text.alias("y"))
    draw = F.struct(F.xxhash64("node", F.lit(step)), text.alias("x"))
    left = members.where(_strong()).groupBy("bucket").agg(F.min(draw).alias("d")).select("bucket", F.col("d.x").alias("x"))
    four, five = SIMILAR
    fits = (four * F.col("y.total") <= F.col("x.room")) & (four * F.col("x.total") <= F.col("y.room"))
    fits &= five * F.least("x.total", "y.total") >= four * F.greatest("x.total", "y.total")
    fits &= _agree("x", "y") >= LEAST_AGREE
    met = left.join(right, (F.col("bucket") == F.col("other")) & (F.col("x.label") != F.col("y.label")) & fits)
    return met.select(
        F.col("x.node").alias("x"), F.col("y.node").alias("y"), F.col("x.label").alias("lx"), F.col("y.label").alias("ly")
    ).distinct()


def _blocks(members: DataFrame, known: DataFrame) -> DataFrame:
    """Two blocks of a bucket at a time, each a list of about ``BLOCK`` members with their texts."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rows = members.join(sizes, "bucket").withColumn("block", dealt).join(known, "node")
    text = F.struct("node", "label", "total", "room", "mark", "bands", "text")
    blocks = rows.groupBy("bucket", "band", "blocks", "block").agg(F.collect_list(text).alias("members"))
    blocks = pin(blocks, "blocks")
    # a block goes to each of its partners, so a large bucket is spread over as many keys as it has blocks
    left = blocks.withColumn("j", F.explode(F.sequence("block", F.col("blocks") - 1))).repartition("bucket", "j")
    right = blocks.select(F.col("bucket"), F.col("block").alias("j"), F.col("members").alias("right"))
    met = left.join(right.repartition("bucket", "j"), ["bucket", "j"])
    return met.select("band", (F.col("block") == F.col("j")).alias("same"), F.col("members").alias("left"), "right")


class _Block:
    """Columns of a list of members."""

    def __init__(self, members: pa.StructArray):
        field = members.field
        self.label, self.text = field("label"), field("text")
        self.name = np.stack([self.label.field(c).to_numpy() for c in ("a", "b")], axis=1)
        self.total, self.room = field("total").to_numpy(), field("room").to_numpy()
        self.mark = pc.list_flatten(field("mark")).to_numpy().reshape(-1, MARK).view(U)
        self.bands = pc.list_flatten(field("bands")).to_numpy().reshape(-1, BANDS)


def _open_pairs(x: _Block, y: _Block, band: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two blocks that the bounds leave open and that meet in this band first."""
    four, five = SIMILAR
    xt, yt = x.total[:, None], y.total[None, :]
    ok = (x.name[:, None] != y.name[None]).any(axis=2)
    ok &= (four * yt <= x.room[:, None]) & (four * xt <= y.room[None, :])
    ok &= five * np.minimum(xt, yt) >= four * np.maximum(xt, yt)
    if same:
        ok &= np.triu(np.ones(ok.shape, bool), 1)
    i, j = np.nonzero(ok)
    odd = x.mark[i] ^ y.mark[j]
    odd |= odd >> U(1)
    odd |= odd >> U(2)
    agree = SIGNATURE - np.bitwise_count(odd & U(0x1111111111111111)).sum(axis=1, dtype=np.int64)
    keep = (agree >= LEAST_AGREE) & ~(x.bands[i, :band] == y.bands[j, :band]).any(axis=1)
    return i[keep], j[keep]


def _block_links(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Labels of the classes that links between members of two blocks bring together."""
    band, same = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    out = []
    for r in range(batch.num_rows):
        x, y = _Block(batch.column(2)[r].values), _Block(batch.column(3)[r].values)
        i, j = _open_pairs(x, y, band[r], same[r])
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a, b = pa.array(i[at : at + PAIRS_AT_ONCE]), pa.array(j[at : at + PAIRS_AT_ONCE])
            linked = pa.array(similar(x.text.take(a), y.text.take(b)))
            found = pa.table([x.label.take(a).filter(linked), y.label.take(b).filter(linked)], names=["x", "y"])
            out.append(found)
    table = pa.concat_tables(out) if out else pa.table([batch.column(2)[:0].flatten().field("label")] * 2, names=["x", "y"])
    table = table.combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns], names=["x", "y"])


def _pairs(members: DataFrame) -> float:
    """Pairs of different classes in all buckets, those of two weak texts left out."""
    strong = F.sum(_strong().cast("long")).alias("s")
    sizes = members.groupBy("bucket", "label").agg(strong, F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("w", F.col("n") - F.col("s")).groupBy("bucket")
    sums = [F.sum("s").alias("s"), F.sum("w").alias("w")]
    sizes = sizes.agg(*sums, F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum(F.col("s") * F.col("w")).alias("sw"))
    return sizes.agg(F.sum((F.col("s") * F.col("s") - F.col("ss")) / 2 + F.col("s") * F.col("w") - F.col("sw"))).first()[0] or 0


def classes(rows: DataFrame) -> DataFrame:
    """``node, label`` of every text that shares a band with a different one."""
    schema = f"node {NODE}, band int, bucket long, mark array<bigint>, bands array<bigint>, total long"
    bands = pin(rows.select("node", "text").mapInArrow(per_batch(lambda: _band_rows), schema), "bands")
    texts = bands.where("mark is not null")
    shared = bands.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    shared = bands.select("bucket", "band", "node").join(shared.select("bucket"), "bucket", "left_semi")
    # a text has one bucket in a band; keys without the bucket let Spark split the join
    shared = pin(shared.groupBy("node", "band").agg(F.first("bucket").alias("bucket")), "shared")
    nodes = shared.select("node").distinct()
    # equal texts share a node, and one text of each node is enough
    known = rows.select("node", "text").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    known = pin(known, "texts")
    marks = texts.join(nodes, "node", "left_semi").groupBy("node")
    marks = marks.agg(*[F.first(c).alias(c) for c in ("mark", "bands", "total")])
    common = pin(_common(known), "common")
    marks = marks.join(common, F.col("node.a") == F.col("a")).where(SIMILAR[1] * F.col("common") >= SIMILAR[0] * F.col("total"))
    marks = pin(marks.select("node", "mark", "bands", "total", _room().alias("room")), "marks")
    labels = pin(marks.select("node", F.col("node").alias("label")), "classes")
    most, last, step = PAIRS_PER_TEXT * texts.count(), float("inf"), 0
    members = pin(_open(shared.join(marks.withColumn("label", F.col("node")), "node")), "members")
    every = False
    while not every and (pairs := _pairs(members)):
        every = step == MAX_ROUNDS or pairs <= most or pairs > last / 2
        if every:
            links = _blocks(members, known).mapInArrow(per_batch(lambda: _block_links), f"x {NODE}, y {NODE}")
        else:
            links = verified(pin(_pivots(members, step), "asked"), known)
            links = links.select(F.col("lx").alias("x"), F.col("ly").alias("y"))
        last, step = pairs, step + 1
        merged = components(links).select(F.col("node").alias("label"), F.col("label").alias("new"))
        labels = labels.join(merged, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
        labels = pin(labels, "classes")
        if not every:
            members = pin(_open(members.drop("label").join(labels, "node")), "members")
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size, kept``: the class is named by its smallest id; one row of it is kept."""
    rows = _rows(docs)
    labels = classes(rows).where("node <> label")
    own = pin(rows.select("doc_id", "node").join(labels, "node", "left"), "nodes")
    own = own.select("doc_id", F.col("node.a").alias("th"), F.coalesce("label", "node").alias("label"))
    size = F.count(F.lit(1)).alias("class_size")
    named = own.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"), size)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "th").eqNullSafe(F.col("first"))
    return own.join(named, "label").select(
        "doc_id", "th", F.col("first.doc_id").alias("class_id"), "class_size", first.alias("kept")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, one row of each class."""
    columns = docs.columns
    keepers = near_duplicates(docs).where("kept").select(F.struct("doc_id", "th").alias("k")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*columns).alias("own"), F.struct("doc_id", F.xxhash64(text).alias("th")).alias("k"))
    again = F.row_number().over(Window.partitionBy("k").orderBy("k"))  # repeated rows: one stays
    kept = rows.join(keepers, "k", "left_semi").withColumn("again", again).where("again = 1")
    return kept.select(*[F.col("own")[c].alias(c) for c in columns])
