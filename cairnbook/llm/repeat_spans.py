"""Removal of long repeated passages: every byte covered by a ``WINDOW``-byte string that also starts anywhere else.

A second, shorter measure only counts: words covered by ``PASSAGE`` words in a row that also stand anywhere else. (Fifty
words may be far fewer than 400 bytes; nothing is removed for them.) Both go through the same steps, at once: the units
of a text are its bytes, and again its words; the lowest bit of an anchor's hash tells them apart.

1. Anchors. Of the strings of ``GRAM`` units inside a window, the one with the smallest hash (the leftmost of equals) is
   the window's anchor; equal windows have equal anchors at equal distance. Neighbouring windows share theirs, so a text
   has an anchor for about every 170 bytes, each with a run of windows and the segment of text these cover.
2. Segments. Equal segments are counted, under their anchor's hash, by two 64-bit hashes. All windows of a segment that
   occurs twice are repeated. An anchor that occurs once, or in one segment only, settles its windows too.
3. Columns. What is left are segments that share an anchor with different ones (the ends of a passage, or an edit inside
   a copy). They are short documents, aligned at their anchors, and their suffixes are sorted column by column from the
   right: each round inserts one symbol per document, a stable sort of the symbols in the order of the round before
   gives the new suffix order, and common prefixes with the neighbours are updated from those of the round before. A
   window is repeated if its suffix has a window's symbols in common with a neighbour. Tasks do this for batches of whole
   anchors. Anchors of more than ``LARGE`` different segments are counted window by window instead, in an aggregation.
4. Repeated windows are merged to spans of each text, and the texts are cut.

Inserting a column of whole documents takes as many global rounds as the longest document has bytes, each over the whole
collection; restricted to segments of step 3 it takes at most 736 rounds inside a task, over a few hundredths of the text.

Common segments and anchors: counts are pre-aggregated in the tasks that read them; the tables that runs are matched with
go to the runs where they are few, else Spark's join splits partitions that one key fills, as nothing but the join stands
in its stage. Texts of over ``SLAB`` units are hashed in slabs that overlap by a window.

Texts are UTF-8 bytes, words what stands between ASCII white space; null counts as empty; texts shorter than a window are
left whole. Repeated rows (of one id, or of none) repeat each other and lose all but short texts. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from . import rolling
from .rolling import U
from .shared import Scratch, prepare, sent_if_small

WINDOW, GRAM = 400, 64
#: The same in words, for the measure of passages.
PASSAGE, PASSAGE_GRAM = 50, 8
#: Units of a text that are hashed at once.
SLAB = 1 << 22
#: Different segments of one anchor up to which a task sorts them; segments that make a batch.
LARGE, BATCH = 20_000, 10_000
CHUNK = 1 << 19
#: Rows of up to five numbers up to which a side is sent to all executors (about 130 MB).
WIDE_ROWS = 1_000_000
_SECOND = rolling._Powers(0xC2B2AE3D27D4EB4F)
_POSITION = (1 << 26) - 1


def units(data: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The values of a chunk's bytes or words, and where each text begins among them."""
    if not words:
        return rolling.BYTE[data], offsets
    start, end, doc = rolling.words(data, offsets)
    return rolling.hash_spans(data, start, end), np.searchsorted(doc, np.arange(len(offsets)))


class Hashes:
    """Two hashes of any span of values, from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self.down = rolling._BYTES.to(n + 1)
        up2, self.down2 = _SECOND.to(n + 1)
        self.total, self.total2 = np.zeros(n + 1, U), np.zeros(n + 1, U)
        np.cumsum(values * up[:n], out=self.total[1:])
        np.cumsum(values * up2[:n], out=self.total2[1:])

    def first(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return rolling.mix((self.total[end] - self.total[start]) * self.down[start])

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return rolling.mix((self.total2[end] - self.total2[start]) * self.down2[start])


def anchors(n: int, offsets: np.ndarray, hashes: Hashes, window: int, gram: int):
    """Text, first and last window start, anchor position of each run of windows with one anchor, among n units."""
    wide = window - gram + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(n - gram + 1)
    packed = (hashes.first(at, at + gram) & ~U(_POSITION)) | at.astype(U)
    padded = np.full(-(-len(packed) // wide) * wide, ~U(0))
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - window + 1)
    least = np.minimum(back[starts], ahead[starts + wide - 1])
    doc = np.searchsorted(offsets, starts, "right") - 1
    whole = starts + window <= offsets[doc + 1]
    starts, doc, anchor = starts[whole], doc[whole], (least[whole] & U(_POSITION)).astype(np.int64)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(starts)) - 1
    return doc[head], starts[head], starts[tail], anchor[head]


def _lists(ends: list[int], columns: dict[str, list[np.ndarray]]) -> pa.Array:
    empty = np.zeros(0, np.int64)
    arrays = [pa.array(np.concatenate([empty, *v]).astype(np.int64), pa.int64()) for v in columns.values()]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, list(columns)))


_RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("gram", "back", "size", "h1", "h2", "start")]))


Sizes = tuple[tuple[int, int], tuple[int, int]]  # window and gram in bytes, in words


def _slabs(values: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A chunk, or the slabs of a long text (alone in its chunk): where it begins, its values and texts."""
    if len(values) <= SLAB:
        yield 0, values, offsets
        return
    for at in range(0, len(values) - window + 1, SLAB):
        piece = values[at : at + SLAB + window - 1]
        yield at, piece, np.array([0, len(piece)])


def _runs_udf(sizes: Sizes):
    @arrow_udf(_RUNS)
    def runs(texts: pa.Array) -> pa.Array:
        names = ("gram", "back", "size", "h1", "h2", "start")
        ends, out = [0], {x: [] for x in names}
        for data, offsets in rolling.chunks(texts, CHUNK):
            docs, found = [], {x: [] for x in names}
            for kind, (window, gram) in enumerate(sizes):
                for shift, values, own in _slabs(*units(data, offsets, bool(kind)), window):
                    hashes = Hashes(values)
                    doc, first, last, anchor = anchors(len(values), own, hashes, window, gram)
                    end = last + window
                    key = (hashes.first(anchor, anchor + gram) & ~U(1)) | U(kind)
                    docs.append(doc)
                    for name, x in zip(names, (key, anchor - first, end - first, hashes.first(first, end), hashes.second(first, end), first - own[doc] + shift), strict=True):
                        found[name].append(x.view(np.int64) if x.dtype == U else x)
            doc = np.concatenate(docs)
            order = np.argsort(doc, kind="stable")
            for name in names:
                out[name].append(np.concatenate(found[name])[order])
            ends.extend((ends[-1] + np.searchsorted(doc[order], np.arange(len(offsets) - 1), "right")).tolist())
        return _lists(ends, out)

    return runs


_WINDOWS = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("gram", "back", "h1", "h2", "start")]))


def _windows_udf(sizes: Sizes):
    """The windows of given segments (start, size, gram, back) of each text."""

    @arrow_udf(_WINDOWS)
    def windows(texts: pa.Array, segments: pa.Array) -> pa.Array:
        ends, out = [0], {x: [] for x in ("gram", "back", "h1", "h2", "start")}
        wanted = iter(segments.to_pylist())
        for data, offsets in rolling.chunks(texts, CHUNK):
            both = [units(data, offsets, bool(kind)) for kind in (0, 1)]
            for i in range(len(offsets) - 1):
                n = ends[-1]
                for x in next(wanted) or []:
                    kind = x["gram"] & 1
                    (values, own), window = both[kind], sizes[kind][0]
                    at = own[i] + x["start"]
                    hashes = Hashes(values[at : at + x["size"]])
                    first = np.arange(x["size"] - window + 1)
                    out["gram"].append(np.full(len(first), x["gram"]))
                    out["back"].append(x["back"] - first)
                    out["h1"].append(hashes.first(first, first + window).view(np.int64))
                    out["h2"].append(hashes.second(first, first + window).view(np.int64))
                    out["start"].append(x["start"] + first)
                    n += len(first)
                ends.append(n)
        return _lists(ends, out)

    return windows


_PIECES = T.ArrayType(
    T.StructType([T.StructField(x, T.LongType()) for x in ("gram", "back", "start")] + [T.StructField("content", T.BinaryType())])
)


@arrow_udf(_PIECES)
def _pieces(texts: pa.Array, segments: pa.Array) -> pa.Array:
    """The bytes of given segments (start, size, gram, back) of each text; of words, the 8 bytes of their hashes."""
    out, wanted = [], iter(segments.to_pylist())
    for data, offsets in rolling.chunks(texts, CHUNK):
        words, first = units(data, offsets, True)
        for i in range(len(offsets) - 1):
            found = []
            for x in next(wanted) or []:
                source, own = (words, first) if x["gram"] & 1 else (data, offsets)
                at = own[i] + x["start"]
                found.append({"gram": x["gram"], "back": x["back"], "start": x["start"], "content": source[at : at + x["size"]].tobytes()})
            out.append(found)
    return pa.array(out, pa.list_(pa.struct([("gram", pa.int64()), ("back", pa.int64()), ("start", pa.int64()), ("content", pa.binary())])))


def symbols_of(contents: list[bytes], words: bool) -> list[np.ndarray]:
    """Each content as small numbers from 1 on, equal for equal bytes or words."""
    if not words:
        return [np.frombuffer(x, np.uint8).astype(np.uint32) + 1 for x in contents]
    values = [np.frombuffer(x, np.uint64) for x in contents]
    rank = np.unique(np.concatenate(values), return_inverse=True)[1].astype(np.uint32) + 1
    return np.split(rank, np.cumsum([len(x) for x in values])[:-1])


def sorted_columns(contents: list[np.ndarray], back: np.ndarray, window: int) -> np.ndarray:
    """Which windows of aligned documents are repeated: row i, column j for the window that starts j before the anchor.

    contents: the documents' symbols, from 1 on; back: where the anchor begins in each.
    """
    m = len(contents)
    left, right = int(back.max()), int(max(len(x) - b for x, b in zip(contents, back.tolist(), strict=True)))
    symbols = np.zeros((left + right, m), np.uint32)  # 0: outside the document
    for i, (x, b) in enumerate(zip(contents, back.tolist(), strict=True)):
        symbols[left - b : left - b + len(x), i] = x
    repeated = np.zeros((m, left + 1), bool)
    order = np.arange(m)
    common = np.zeros(m + 1, np.int64)  # of the k-th suffix and the one before it; one more, for ranges that end at m
    for c in range(left + right - 1, -1, -1):
        symbol = symbols[c][order]
        new = np.argsort(symbol, kind="stable")
        here, there = new[1:], new[:-1]
        joined = (symbol[here] == symbol[there]) & (symbol[here] > 0)
        longest = np.zeros(m + 1, np.int64)
        near = np.flatnonzero(joined & (here == there + 1))
        longest[near + 1] = common[here[near]] + 1
        apart = np.flatnonzero(joined & (here != there + 1))
        if len(apart):
            ends = np.stack([there[apart] + 1, here[apart] + 1], axis=1).ravel()
            longest[apart + 1] = np.minimum.reduceat(common, ends)[::2] + 1
        order, common = order[new], longest
        if c <= left:
            hit = common[:-1] >= window
            hit[:-1] |= common[1:-1] >= window
            repeated[order[hit], left - c] = True
    return repeated


_SPAN = T.StructType([T.StructField(x, T.LongType()) for x in ("id", "tag", "kind", "start", "end")])


def _columns_udf(sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by kind and gram; a batch is cut only between grams."""
        held: list[dict] = []

        def spans(rows: list[dict]) -> pa.RecordBatch:
            kind = rows[0]["gram"] & 1
            window = sizes[kind][0]
            back = np.array([r["back"] for r in rows], np.int64)
            hits = sorted_columns(symbols_of([r["content"] for r in rows], bool(kind)), back, window)[:, ::-1]  # now by ascending start
            edge = np.zeros((hits.shape[0], hits.shape[1] + 2), np.int8)
            edge[:, 1:-1] = hits
            step = np.diff(edge, axis=1)
            row, first = np.nonzero(step == 1)
            _, last = np.nonzero(step == -1)
            shift = np.array([r["start"] for r in rows], np.int64) + back - (hits.shape[1] - 1)
            of = lambda name: pa.array([rows[i][name] for i in row.tolist()], pa.int64())
            return pa.RecordBatch.from_arrays(
                [of("id"), of("tag"), pa.array(np.full(len(row), kind, np.int64)), pa.array(shift[row] + first), pa.array(shift[row] + last - 1 + window)], _SPAN.names
            )

        for batch in batches:
            for r in batch.to_pylist():
                if held and r["gram"] != held[-1]["gram"] and (len(held) >= BATCH or (r["gram"] ^ held[-1]["gram"]) & 1):
                    yield spans(held)
                    held = []
                held.append(r)
        if held:
            yield spans(held)

    return run


_COUNTS = ("n_bytes", "n_removed", "n_spans")
_CUT = T.StructType([
    *(T.StructField(x, T.LongType()) for x in _COUNTS),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("n_passage_words", T.LongType()),
    T.StructField("kept", T.BinaryType()),
])


def _merged(spans: list[dict], kind: int) -> list[tuple[int, int]]:
    """The maximal runs that spans of one kind cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((x["start"], x["end"]) for x in spans if x["kind"] == kind):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut_udf(with_kept: bool):
    @arrow_udf(_CUT)
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans, strict=True):
            data, found = (text.as_py() or "").encode(), found.as_py() or []
            removed, passages = _merged(found, 0), _merged(found, 1)
            edges = [0, *(x for span in removed for x in span), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            counts = (len(data), len(data) - len(rest), len(removed))
            more = (hashlib.sha256(rest).hexdigest(), sum(b - a for a, b in passages), rest if with_kept else None)
            out.append(dict(zip(_CUT.names, (*counts, *more), strict=True)))
        kinds = [*((x, pa.int64()) for x in _COUNTS), ("kept_sha256", pa.string()), ("n_passage_words", pa.int64()), ("kept", pa.binary())]
        return pa.array(out, pa.struct(kinds))

    return cut


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["tag"] == right["tag"])


def without_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, passage: int = PASSAGE, passage_gram: int = PASSAGE_GRAM, large: int = LARGE, with_kept: bool = True) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words, kept (the remaining bytes)."""
    prepare(spark)
    scratch = Scratch(spark, "repeats")
    sizes = ((window, gram), (passage, passage_gram))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    segment = ["gram", "back", "size", "h1", "h2"]
    kind = (F.col("gram").bitwiseAND(F.lit(1))).alias("kind")
    runs = source.select("id", "tag", F.explode(_runs_udf(sizes)("text")).alias("r")).select("id", "tag", "r.*")
    runs = scratch.keep(runs, "runs")
    grams = scratch.keep(runs.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
    twice = scratch.keep(runs.join(sent_if_small(grams), "gram", "left_semi"), "twice")
    scratch.drop("runs", "grams")
    kinds = scratch.keep(twice.groupBy(*segment).agg(F.count("*").alias("n"), F.min(F.struct("id", "tag", "start")).alias("one")), "kinds")
    mixed = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("gram", "kinds")
    mixed = scratch.keep(mixed, "mixed")
    several = scratch.keep(kinds.where("n > 1").select(*segment), "several")
    same = twice.join(sent_if_small(several, WIDE_ROWS), segment, "left_semi").select("id", "tag", kind, "start", (F.col("start") + F.col("size")).alias("end"))
    open_ = scratch.keep(kinds.join(sent_if_small(mixed, WIDE_ROWS), "gram").select("one.*", "gram", "back", "size", "kinds"), "open")
    few, many = open_.where(F.col("kinds") <= large), open_.where(F.col("kinds") > large)

    def with_text(segments: DataFrame, name: str, udf) -> DataFrame:
        wanted = segments.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "size", "gram", "back")).alias("segments"))
        wanted = scratch.keep(wanted, f"wanted-{name}")
        joined = source.join(wanted, _same_row(source, wanted))
        return joined.select(source["id"], source["tag"], F.explode(udf("text", "segments")).alias("w")).select("id", "tag", "w.*")

    pieces = with_text(few, "few", _pieces).repartition("gram").sortWithinPartitions(kind, "gram")
    found = scratch.keep(pieces.mapInArrow(_columns_udf(sizes), _SPAN), "found")
    if not many.isEmpty():
        windows = scratch.keep(with_text(many, "many", _windows_udf(sizes)), "windows")
        key = ["gram", "back", "h1", "h2"]
        again = scratch.keep(windows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "again")
        wide = F.when(kind == 0, window).otherwise(passage)
        more = windows.join(sent_if_small(again, WIDE_ROWS), key, "left_semi").select("id", "tag", kind, "start", (F.col("start") + wide).alias("end"))
        found = found.unionByName(more)
    spans = same.unionByName(found).groupBy("id", "tag").agg(F.collect_list(F.struct("kind", "start", "end")).alias("spans"))
    spans = scratch.keep(spans, "spans")
    scratch.drop("twice", "kinds", "mixed", "several", "open", "wanted-few", "wanted-many", "found", "windows", "again")
    out = source.join(spans, _same_row(source, spans), "left").select(source["id"].alias(id_col), _cut_udf(with_kept)("text", "spans").alias("c"))
    return out.select(id_col, "c.*")


def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return without_repeats(spark, docs, with_kept=False).drop("kept")
