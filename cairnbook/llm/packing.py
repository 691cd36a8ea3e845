"""Cost-balanced packing of documents into training sequences.

Documents are encoded and packed in batches of about ``batch_tokens`` tokens inside the tasks that read them, without a
shuffle. In a batch, whole sequences are cut from documents longer than one; the rest is assigned in descending order
of estimated attention cost (linear plus quadratic in length), each to the lowest-cost sequence with room for it, or,
where none has room for all of it, cut to fill the lowest-cost sequence with room left. A batch's sequences hold exactly
its tokens: as many of full length as fit, then one for each power of two in the remainder, so nothing is padded.

Null or empty text: one piece with the end id alone. Repeated rows are packed once each; very long texts are cut into
many sequences; null ids pass through. Other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rolling

SEQUENCE = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
BATCH_TOKENS = 1 << 20
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n. The ratio is that of a 2,048-wide layer.
LINEAR, QUADRATIC = 12 * 2048, 2
#: Distinct pieces that a worker knows at most, before it starts afresh.
_CACHE = 300_000
_MARKS = ("<|startoftext|>", "<|endoftext|>")
#: Kinds of bytes: white space; letters; other ASCII; the rest, which stays with whatever it stands beside.
_SPACE, _LETTER, _SIGN, _REST = range(4)
_KIND = np.full(256, _REST, np.uint8)
_KIND[:128] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[rolling.SPACE] = _SPACE
_KIND[ord("'")] = _REST


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and text number of each piece.

    The tokenizer lower-cases, and never joins across white space, or a letter with a sign; texts are cut there, as far
    as bytes show it: letters are those of ASCII and of the Latin-1 block (bytes C3 80 to C3 BF without 97 and B7).
    Apostrophes (as in 's) and other scripts stay with their neighbours, so a piece may still be several tokens.
    """
    kind = _KIND[data]
    lower = rolling.LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    if len(lead):
        after = data[lead + 1]
        lead = lead[(after != 0x97) & (after != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        lower[lead + 1] |= 0x20  # C3 80..9E are the capitals of C3 A0..BE
        lower[lead[data[lead + 1] == 0x9F] + 1] = 0x9F  # a small letter without a capital
    solid = kind != _SPACE
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    before[offsets[:-1][offsets[1:] > offsets[:-1]]] = _SPACE
    starts = np.flatnonzero(solid & ((before == _SPACE) | (kind + before == _LETTER + _SIGN) & (kind != _REST) & (before != _REST)))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    if len(ends):
        ends[-1] = len(data)
    # a piece ends where the next begins, or at white space before that, or with its text
    gap = np.flatnonzero(~solid)
    if len(gap):
        first = np.searchsorted(gap, starts)
        near = np.where(first < len(gap), gap[np.minimum(first, len(gap) - 1)], len(data))
        ends = np.minimum(ends, near)
    doc = np.searchsorted(offsets, starts, "right") - 1
    return lower, starts, np.minimum(ends, offsets[doc + 1]), doc


class Encoder:
    """Ids of whole texts: each distinct piece is encoded once, found by its 64-bit hash from then on."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        for name, i in names.items():
            self.last[i] = name.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.ids, self.size, self.starts = np.zeros(1 << 20, np.uint32), 0, array("q", [0])

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: list[int], new: list[str]) -> None:
        found: list[list[int]] = []
        for at in range(0, len(new), 2000):
            part = new[at : at + 2000]
            ids = np.array(self._encoded([" ".join(part)])[0], np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and all(x.isalpha() for x in part):  # one token end each
                bounds, flat = [0, *ends.tolist()], ids.tolist()
                found += [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            else:
                found += self._encoded(part)
        flat = [i for x in found for i in x]
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.size : self.size + len(flat)] = flat
        n = len(self.starts) - 1
        self.index.update(zip(hashes, range(n, n + len(new)), strict=True))
        self.starts.extend((self.size + np.cumsum([len(x) for x in found])).tolist())
        self.size += len(flat)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> list[np.ndarray]:
        """For each text its ids, then ``end``."""
        if len(self.index) > _CACHE:
            self.forget()
        n = len(offsets) - 1
        lower, start, stop, doc = pieces(data, offsets)
        value, first, which = np.unique(rolling.hash_spans(lower, start, stop), return_index=True, return_inverse=True)
        keys = value.tolist()
        at = np.fromiter(map(self.index.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        if len(new):
            whole = lower.tobytes()
            words = [whole[a:b].decode() for a, b in zip(start[first[new]].tolist(), stop[first[new]].tolist(), strict=True)]
            simple = np.array([w.isalpha() for w in words], bool)
            for part in (np.flatnonzero(simple), np.flatnonzero(~simple)):
                self.learn([keys[i] for i in new[part].tolist()], [words[i] for i in part.tolist()])
            at[new] = [self.index[keys[i]] for i in new.tolist()]
        starts = np.array(self.starts, np.int64)
        begin, size = starts[at][which], (starts[at + 1] - starts[at])[which]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        bounds = total[np.searchsorted(doc, np.arange(n + 1))]
        out = [np.append(flat[a:b], np.uint32(end)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        raw = data.tobytes()
        if any(m.encode() in raw for m in _MARKS):  # the tokenizer's own marks are one token each, wherever they stand
            for i in range(n):
                text = raw[offsets[i] : offsets[i + 1]].decode()
                if any(m in text for m in _MARKS):
                    out[i] = np.array([*self._encoded([text])[0], end], np.uint32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker: its words stay known to the worker's next tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequence numbers count from 0."""
    pieces, rest, n = [], [], 0
    for i, length in enumerate(lengths):
        for k in range(length // sequence):
            pieces.append((i, k * sequence, sequence, n, 0))
            n += 1
        if length % sequence:
            rest.append((i, length // sequence * sequence, length % sequence))
    total = sum(x[2] for x in rest)
    room = np.array([sequence] * (total // sequence) + [1 << b for b in range(sequence.bit_length() - 1, -1, -1) if total % sequence >> b & 1], np.int64)
    filled, load = np.zeros(len(room), np.int64), np.zeros(len(room), np.float64)
    for i, start, length in sorted(rest, key=lambda x: -cost(x[2])):
        while length:
            fits = np.flatnonzero(room >= length)
            where = fits if len(fits) else np.flatnonzero(room)
            b = int(where[np.argmin(load[where])])
            part = min(length, int(room[b]))
            pieces.append((i, start, part, n + b, int(filled[b])))
            room[b] -= part
            filled[b] += part
            load[b] += cost(part)
            start, length = start + part, length - part
    return pieces


_PIECE = T.StructType([
    T.StructField(x, T.LongType())
    for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
])


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, batch_tokens: int = BATCH_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 36
        ids: list[int | None] = []
        docs: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal first, tokens
            rows = pack([len(x) for x in docs], sequence)
            out = [
                (ids[i], start, n, zlib.crc32(docs[i][start : start + n].astype("<u4").tobytes()), len(docs[i]), first + s, offset)
                for i, start, n, s, offset in rows
            ]
            first += max(x[3] for x in rows) + 1
            ids.clear(), docs.clear()
            tokens = 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], _PIECE.names)

        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            for data, offsets in rolling.chunks(batch.column(1)):
                for x in coder.encode(data, offsets, end_id):
                    ids.append(next(names))
                    docs.append(x)
                    tokens += len(x)
                    if tokens >= batch_tokens:
                        yield flush()
        if docs:
            yield flush()

    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return source.mapInArrow(run, _PIECE)


def op8(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packed(docs, public_tokenizers.path(TOKENIZER))
