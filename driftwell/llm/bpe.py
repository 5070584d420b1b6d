"""Byte-level BPE by forced boundaries.

Two bytes that stand side by side inside no token of the vocabulary can never be joined, so the
place between them is a certain cut. A pretoken is split at all certain cuts, the fragments are
encoded independently of each other and of their order, and the ids are concatenated.

Defined cases: a null or empty text has no ids and decodes to the empty text. Contents of added
tokens found in a text become their ids, as the tokenizers library does by default. Repeated rows
give repeated results, an empty table an empty one; a very long text is encoded piece by piece, in memory in
proportion to its ids; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import heapq
import json
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from driftwell.llm.table import per_batch

# Fixed value: the published pretoken pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY_BYTES = 64 << 20
CACHE = 1 << 18  # entries
CACHED = 64  # longest piece that is kept, in letters or bytes: an entry has a bounded size
SHORT = 32
LOW, NEVER = (1 << 32) - 1, 1 << 64  # a rank and the id it leads to, in one number


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones stand for themselves,
    the others follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Fragments(dict):
    """Text piece -> its ids, packed as little-endian unsigned 32-bit numbers. Keeps the pieces seen last:
    when full, the entries of the time before are dropped and the present ones take their place."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.earlier = encode, {}

    def __missing__(self, piece):
        if len(self) >= CACHE:
            self.earlier = dict(self)
            self.clear()
        ids = self.earlier.get(piece) or self.encode(piece)
        if len(piece) <= CACHED:
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec["normalizer"] or pre.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without a normaliser or prefix space is supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip their surroundings are not supported")
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.tokens = [named.get(i, b"") for i in range(max(named) + 1)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        for rank, pair in enumerate(model["merges"]):
            left, right = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[self.ids[left], self.ids[right]] = rank, self.ids[left + right]
        self.ranked = {pair: rank << 32 | i for pair, (rank, i) in self.merges.items()}
        self.joined = {pair for token in self.ids for pair in zip(token, token[1:], strict=False)}
        self.pieces = Fragments(lambda piece: self.encode_piece(piece.encode()))
        self.fragments = Fragments(lambda part: pack(self.merge(part)))
        self.find = regex.compile(PATTERN).findall
        found = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.split = regex.compile(f"({found})").split if found else lambda text: [text]

    def cuts(self, piece: bytes) -> list[int]:
        """The places that no token can lie across."""
        joined = self.joined
        return [i for i, pair in enumerate(zip(piece, piece[1:], strict=False), 1) if pair not in joined]

    def encode_piece(self, piece: bytes) -> bytes:
        if not (cuts := self.cuts(piece)):
            return pack(self.merge(piece))
        at = [0, *cuts, len(piece)]
        return b"".join([self.fragments[piece[a:b]] for a, b in zip(at, at[1:], strict=False)])

    def merge(self, part: bytes) -> list[int]:
        """Ids of one fragment: of all neighbours, the pair of least rank is joined first, leftmost first."""
        ids = [self.single[b] for b in part]
        if len(ids) <= SHORT:
            return self.merge_short(ids)
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        merges = self.merges
        heap = [(merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = merges[pair][1], -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (p := (ids[a], ids[b])) in merges:
                    heapq.heappush(heap, (merges[p][0], a, p))
        return [i for i in ids if i >= 0]

    def merge_short(self, ids: list[int]) -> list[int]:
        """The same for a few bytes: ranks of neighbours are kept in a list and mended beside each join."""
        find, none = self.ranked.get, NEVER
        ranks = [find(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = best & LOW
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = find((ids[i], ids[i + 1]), none)
        return ids

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        out = []
        for n, part in enumerate(self.split(text)):
            if n % 2:
                out.append(pack([self.added[part]]))
            elif part:
                out.extend(map(self.pieces.__getitem__, self.find(part)))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary: packed little-endian unsigned 32-bit numbers) and ``decoded``, the text
    that the ids give back. ``vocabulary`` is the path of a tokenizer file; its bytes are broadcast after a
    check of their number. No shuffle."""
    raw = Path(vocabulary).read_bytes()
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary has {len(raw)} bytes; {MAX_VOCABULARY_BYTES} may be broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def make():
        encoder = Encoder(shared.value)

        def each(batch):
            packed = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            decoded = [encoder.decode(p) for p in packed]
            columns = [batch.column(0), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(per_batch(make), f"doc_id {kind}, ids binary, decoded string")
