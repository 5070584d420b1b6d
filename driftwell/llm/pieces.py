"""SentencePiece BPE by a table of last tokens.

Merge-type BPE joins, of all neighbours whose text together is a piece, those of the highest score, the
leftmost of equals. Joins never look beyond the two neighbours, so any stretch of whole tokens of an encoding is
the encoding of its own text, and a sequence of tokens is the encoding of its text exactly if each pair of
neighbours is: two tokens are compatible if their text together is encoded as these two. A prefix of a text has
one encoding, hence one last token: of the pieces that end there (an automaton finds them), the only one that is
compatible with the last token of the prefix before it. The table keeps that token for each prefix, one entry a
letter; the ids are then read off backwards. Compatibility is decided by the joins themselves, once a pair.

Before that, a text is cut where a blank follows another letter and between letters of words and other signs, if no
piece of the vocabulary has that inside: nothing is joined across. Short fragments are remembered.

Defined cases: a null or empty text has no ids and decodes to the empty text. Letters that no piece holds become
their UTF-8 bytes. U+2581 in a text is a blank, as in the library. A very long text without blanks takes memory
in proportion to its length. Repeated rows give repeated results, an empty table an empty one; columns other than
``doc_id`` and ``text`` are not read. There are no ties: each piece is one id.
"""

from __future__ import annotations

import codecs
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from driftwell.llm.table import per_batch

MAX_MODEL_BYTES = 64 << 20
REMEMBERED = 1 << 17  # fragments
REMEMBERED_LETTERS = 32  # of a fragment, at most
PAIRS = 1 << 21  # decided pairs that are kept
BLANK = "▁"
WORD_LETTER, OTHER = r"[\p{L}\p{M}]", r"[^\p{L}\p{M}" + BLANK + "]"
UNKNOWN_TEXT = " ⁇ "
# Numbers of the published model format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
NOTHING = b""


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at : at + size]
        at += size


class Model:
    """Pieces of a model file with their scores and kinds."""

    def __init__(self, raw: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = {}, {}
        for field, value in _fields(raw):
            if field == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                self.pieces.append((own[1].decode(), score, own.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != BPE:
            raise ValueError("only merge-type models are supported")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that change nothing but blanks and put one first are supported")
        kinds = [kind for _, _, kind in self.pieces]
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or kinds.count(BYTE) != 256:
            raise ValueError("only models of plain pieces with all 256 bytes are supported")


class PieceTable:
    def __init__(self, raw: bytes):
        pieces = Model(raw).pieces
        self.texts = [p for p, _, _ in pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.loss = {p: -score for p, score, kind in pieces if kind == NORMAL}
        self.byte = [0] * 256
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[int(p[1:-1], 16)] = i
        self.shown = [self._shown(p, kind) for p, _, kind in pieces]
        self.silent = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.led = {i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL and p.startswith(BLANK)}
        # letters that stand in pieces without being one can still be joined: they get numbers of their own
        lone = sorted({c for p in self.ids for c in p} - set(self.ids))
        self.texts += lone
        self.known = len(pieces)
        self.sizes = [len(t) for t in self.texts]
        self.after: list[dict[int, bool]] = [{} for _ in self.texts]  # token -> the one before -> compatible
        self.decided = 0
        self.ends = ahocorasick.Automaton()
        for token, text in [*((i, p) for p, i in self.ids.items()), *enumerate(lone, self.known)]:
            self.ends.add_word(text, (token, len(text), self.after[token]))
        self.ends.make_automaton()
        self.fragments = regex.compile(f"(?s){self.cuts()}").findall
        self.remembered: dict[str, bytes] = {}

    @staticmethod
    def _shown(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        return {CONTROL: "", UNKNOWN: UNKNOWN_TEXT}.get(kind, piece.replace(BLANK, " ")).encode()

    def cuts(self) -> str:
        """A pattern of fragments that no piece reaches across: at blanks after other letters, and between letters of
        words and other signs, where the vocabulary allows it."""
        inner = [p.lstrip(BLANK) for p in self.ids]
        if any(BLANK in p for p in inner):
            return ".+"
        mixed = regex.compile(f"{WORD_LETTER}{OTHER}|{OTHER}{WORD_LETTER}").search
        if any(map(mixed, inner)):
            return f"{BLANK}*[^{BLANK}]+|{BLANK}+"
        return f"{BLANK}*{WORD_LETTER}+|{BLANK}*{OTHER}+|{BLANK}+"

    def compatible(self, left: int, right: int) -> bool:
        """Whether the text of both tokens is encoded as these two; ``left`` may be -1, nothing."""
        before = self.texts[left] if left >= 0 else ""
        parts, edge = [*before, *self.texts[right]], len(before)
        loss, never = self.loss.get, float("inf")
        losses = [loss(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        inner = edge  # parts on the left side
        while losses and (least := min(losses)) < never:
            i = losses.index(least)
            if inner and i == inner - 1:
                return False
            inner -= i < inner
            parts[i] += parts.pop(i + 1)
            del losses[i]
            if i:
                losses[i - 1] = loss(parts[i - 1] + parts[i], never)
            if i < len(losses):
                losses[i] = loss(parts[i] + parts[i + 1], never)
        return len(parts) == (2 if left >= 0 else 1)

    def table(self, text: str) -> list[int]:
        """The last token of each prefix but the empty one; -1 for those that end in a letter of no piece."""
        last = [-1] * len(text)
        done = -1
        for end, (token, size, known) in self.ends.iter(text):
            if end == done:
                continue
            before = last[end - size]  # nothing is before the first letter: the last entry, not set yet
            fits = known.get(before)
            if fits is None:
                fits = self.decide(before, token)
            if fits:
                last[end] = token
                done = end
        return last

    def decide(self, before: int, token: int) -> bool:
        if self.decided >= PAIRS:
            self.decided = 0
            for pairs in self.after:
                pairs.clear()
        self.decided += 1
        fits = self.after[token][before] = self.compatible(before, token)
        return fits

    def encode_fragment(self, text: str) -> bytes:
        last, at, ids, sizes = self.table(text), len(text) - 1, [], self.sizes
        while at >= 0:
            token = last[at]
            if 0 <= token < self.known:
                ids.append(token)
                at -= sizes[token]
            else:
                ids.extend(self.byte[b] for b in reversed(text[at].encode()))
                at -= 1
        ids.reverse()
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as packed little-endian 32-bit numbers."""
        out, remembered = [], self.remembered
        for part in self.fragments(BLANK + text.replace(" ", BLANK)) if text else ():
            ids = remembered.get(part)
            if ids is None:
                ids = self.encode_fragment(part)
                if len(part) <= REMEMBERED_LETTERS:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    remembered[part] = ids
            out.append(ids)
        return NOTHING.join(out)

    def decode(self, ids: list[int]) -> str:
        first = next((i for i in ids if i not in self.silent), -1)
        runs = [ids] if self.silent.isdisjoint(ids) else split_at(ids, self.silent)  # bytes on both sides form no letter
        shown = [NOTHING.join(map(self.shown.__getitem__, run)).decode("utf-8", "driftwell-each-byte") for run in runs]
        return "".join(shown)[first in self.led :]


def split_at(ids: list[int], marks: set[int]) -> list[list[int]]:
    """The stretches of ``ids`` between members of ``marks``."""
    return [list(run) for marked, run in groupby(ids, marks.__contains__) if not marked]


# bytes that are no letters become a replacement character each
codecs.register_error("driftwell-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


@lru_cache(maxsize=1)
def piece_table(raw: bytes) -> PieceTable:
    """The table of a model; a worker keeps it for its next task."""
    return PieceTable(raw)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded``, the text that the ids give back. ``model`` is the path of
    a model file; its bytes are broadcast after a check of their number. No shuffle."""
    raw = Path(model).read_bytes()
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"the model has {len(raw)} bytes; {MAX_MODEL_BYTES} may be broadcast")
    Model(raw)
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def make():
        pieces = piece_table(shared.value)

        def each(batch):
            packed = [np.frombuffer(pieces.encode(t or ""), "<i4") for t in batch.column(1).to_pylist()]
            decoded = [pieces.decode(ids.tolist()) for ids in packed]
            ends = np.cumsum([0, *map(len, packed)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.concatenate(packed).astype(np.int32))
            columns = [batch.column(0), ids, pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(per_batch(make), f"doc_id {kind}, ids array<int>, decoded string")
