"""Benchmark decontamination by template windows.

A text becomes a template: letters lower-cased, punctuation dropped, numbers, names and units replaced with typed
placeholders (a name is a capitalised word inside a sentence; a unit follows a number; runs of names are one name).
Windows of ``WINDOW`` template tokens, most of them literal, are hashed; windows of the documents are hash-joined to
those of the benchmark. Of one document, one item and one alignment, the slots must be consistent: one benchmark value
always stands for one document value (two may fall on the same). An item leaks into a document if consistent alignments cover at
least ``COVERAGE`` of its windows; it is re-parameterised if a slot's value differs. Items shorter than a window, of
one token even, are matched as a whole. Items without a window of enough literal tokens (rows of numbers, sums,
conversions, lists of names) would match anything of that form; their windows are hashed with the slots' values, so they are found
where they stand word for word. (The first word of an item is literal; in a document it is a name where it is capitalised
and follows a word or comma. One window of a long item is lost by that, but an item shorter than a window.)

Where the benchmark's windows are few enough (``PREFILTER``), the tasks that read the documents drop windows that no
item has, before the join; beyond it all windows are joined.

Null or empty texts have no windows and match nothing; documents or items with null ids are not reported; repeated rows
of one id count once. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from . import rolling
from .rolling import U
from .shared import Scratch, prepare

WINDOW = 8
#: Literal tokens in a window, at least.
LITERAL = 4
COVERAGE = 0.5
#: Distinct benchmark windows (8 bytes each) up to which they are sent to the tasks.
PREFILTER = 2_000_000

#: Units that may follow a number.
UNITS = (
    "kg g mg lb lbs oz t km m cm mm mi ft in yd l ml h hr hrs min s ms day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres mile miles foot feet inch inches liter liters "
    "litre litres gram grams kilogram kilograms pound pounds dollar dollars euro euros cent cents percent degree degrees "
    "usd eur gbp kwh kw w v a hz khz mhz ghz kb mb gb tb kmh mph"
).split()

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
#: What may stand before a capitalised word inside a sentence.
_INSIDE = _LETTER | _DIGIT
_INSIDE[[39, 44]] = True
NUMBER, NAME, UNIT = (rolling.mix(np.array([x], U)) for x in (11, 12, 13))


def _before(data: np.ndarray, offsets: np.ndarray, fill: int = 10) -> np.ndarray:
    out = np.empty_like(data)
    out[1:] = data[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    out[heads] = fill
    return out


def _after(data: np.ndarray, offsets: np.ndarray, fill: int = 10) -> np.ndarray:
    out = np.empty_like(data)
    out[:-1] = data[1:]
    tails = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    out[tails] = fill
    return out


def templates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template token, slot value (0: literal) and text number of each token."""
    prev, after = _before(data, offsets), _after(data, offsets)
    lower = rolling.LOWER[data]
    accented = (prev == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    lower = np.where(accented, data + 0x20, lower).astype(np.uint8)
    digit = _DIGIT[data] | (((data == 46) | (data == 44)) & _DIGIT[prev] & _DIGIT[after])
    mark = (data == 0xC2) | (prev == 0xC2)  # signs and no-break space
    dash = (data == 0xE2) & (after == 0x80)  # dashes and quotes
    mark |= dash
    mark[1:] |= dash[:-1]
    mark[2:] |= dash[:-2]
    letter = _LETTER[data] & ~mark
    s1, e1, d1 = rolling.runs(letter, offsets)
    s2, e2, d2 = rolling.runs(digit, offsets)
    order = np.argsort(np.concatenate([s1, s2]), kind="stable")
    start, end, doc = (np.concatenate(x)[order] for x in ((s1, s2), (e1, e2), (d1, d2)))
    number = order >= len(s1)
    value = rolling.hash_spans(lower, start, end)
    if not len(start):
        return value, value, doc

    ink = np.maximum.accumulate(np.where(rolling.SPACE[data], -1, np.arange(len(data))))
    last = np.where(start > offsets[doc], ink[np.maximum(start - 1, 0)], -1)
    newlines = np.concatenate([[0], np.cumsum(data == 10)])
    inside = (last >= offsets[doc]) & _INSIDE[data[np.maximum(last, 0)]] & (newlines[start] == newlines[np.maximum(last, 0)])
    capital = _UPPER[data[start]] | ((data[start] == 0xC3) & accented[np.minimum(start + 1, len(data) - 1)])
    second = start + np.where(data[start] >= 0x80, 2, 1)
    more = second < end
    second = np.minimum(second, len(data) - 1)
    small = (lower[second] >= 97) & ~_UPPER[data[second]] & ~((data[second] == 0xC3) & accented[np.minimum(second + 1, len(data) - 1)])
    name = ~number & capital & inside & more & small
    follows = np.zeros(len(start), bool)
    follows[1:] = doc[1:] == doc[:-1]
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1] & follows[1:] & ~number[1:] & np.isin(value[1:], _units())
    name &= ~unit
    joined = np.zeros(len(start), bool)  # goes on with the name before
    joined[1:] = name[1:] & name[:-1] & follows[1:]
    head = np.flatnonzero(~joined)
    slot = np.where(number | name | unit, value | U(1), U(0))
    slot = np.add.reduceat(slot, head)
    token = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, value)))
    return token[head], slot, doc[head]


_known: list[np.ndarray] = []


def _units() -> np.ndarray:
    if not _known:
        data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        start, end, _ = rolling.words(data, np.array([0, len(data)]))
        _known.append(rolling.hash_spans(data, start, end))
    return _known[0]


_WINDOWS = T.ArrayType(
    T.StructType([
        T.StructField("hash", T.LongType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("exact", T.BooleanType()),
        T.StructField("slots", T.ArrayType(T.LongType())),
    ])
)


def windows_udf(sizes: list[int], known: np.ndarray | None, whole_only: bool = False):
    """A function from texts to their windows of the given sizes; only those in ``known``, if it is given.

    A window is hashed by its template, and one of too few literal tokens by its template and slots (``exact``).
    whole_only: of the sizes below WINDOW, only windows that are the whole text.
    """
    table = None
    if known is not None:
        known = np.sort(known.view(U))
        table = np.zeros(1 << 22, bool)
        table[(known & U((1 << 22) - 1)).astype(np.int64)] = True

    @arrow_udf(_WINDOWS)
    def windows(texts: pa.Array) -> pa.Array:
        ends, hashes, positions, exact, slots, slot_ends = [0], [], [], [], [], [0]
        for data, offsets in rolling.chunks(texts):
            token, slot, doc = templates(data, offsets)
            n = len(offsets) - 1
            first = np.searchsorted(doc, np.arange(n + 1))
            literal = np.concatenate([[0], np.cumsum(slot == 0)])
            full = rolling.mix(token + rolling.mix(slot + U(29)))
            found = []
            for size in sizes:
                at, h = rolling.hash_windows(token, doc, size)
                poor = literal[at + size] - literal[at] < min(LITERAL, size)
                if poor.any():
                    h = np.where(poor, rolling.hash_windows(full, doc, size)[1], h)
                keep = np.ones(len(at), bool)
                if whole_only and size < WINDOW:
                    keep &= first[doc[at] + 1] - first[doc[at]] == size
                if table is not None:
                    keep &= table[(h & U((1 << 22) - 1)).astype(np.int64)]
                at, h, poor = at[keep], h[keep], poor[keep]
                if table is not None and len(h):
                    there = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                    at, h, poor = at[there], h[there], poor[there]
                found.append((at, h, np.full(len(at), size), poor))
            at, h, size, poor = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(at, kind="stable")
            at, h, size = at[order], h[order], size[order]
            hashes.append(h.view(np.int64))
            exact.append(poor[order])
            positions.append((at - first[doc[at]]).astype(np.int32))
            ends.extend((ends[-1] + np.searchsorted(doc[at], np.arange(n), "right")).tolist())
            for a, k in zip(at.tolist(), size.tolist(), strict=True):
                slots.append(slot[a : a + k].view(np.int64))
                slot_ends.append(slot_ends[-1] + k)
        empty = np.zeros(0, np.int64)
        entries = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate([empty, *hashes]), pa.int64()),
                pa.array(np.concatenate([empty, *positions]).astype(np.int32), pa.int32()),
                pa.array(np.concatenate([np.zeros(0, bool), *exact]), pa.bool_()),
                pa.ListArray.from_arrays(pa.array(slot_ends, pa.int32()), pa.array(np.concatenate([empty, *slots]), pa.int64())),
            ],
            ["hash", "position", "exact", "slots"],
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)

    return windows


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, n_windows, item_windows, reparameterised."""
    prepare(spark)
    sizes = list(range(1, WINDOW + 1))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("item_id is not null")
    item_windows = items.select("item_id", F.explode(windows_udf(sizes, None, whole_only=True)("text")).alias("w"))
    item_windows = item_windows.select("item_id", "w.hash", F.col("w.position").alias("item_position"), F.col("w.slots").alias("item_slots"), "w.exact")
    item_windows = Scratch(spark, "leaks").keep(item_windows.dropDuplicates(["item_id", "hash", "item_position"]), "items")
    rich = item_windows.where("not exact").select("item_id").distinct()
    item_windows = item_windows.where("not exact").unionByName(item_windows.where("exact").join(rich, "item_id", "left_anti").select(item_windows.columns)).drop("exact")
    total = item_windows.groupBy("item_id").agg(F.countDistinct("item_position").alias("item_windows"))
    distinct = item_windows.select("hash").distinct()
    used = sorted(item_windows.agg(F.collect_set(F.size("item_slots")).alias("sizes")).first().sizes) or [WINDOW]  # eight numbers at most
    known = distinct.toArrow()["hash"].to_numpy() if distinct.count() <= PREFILTER else None
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    mine = rows.select("doc_id", F.explode(windows_udf(used, known)("text")).alias("w"))
    mine = mine.select("doc_id", "w.hash", "w.position", "w.slots")
    met = mine.join(item_windows, "hash").withColumn("diagonal", F.col("position") - F.col("item_position"))
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda x: x["item_slots"] != 0)
    run = met.groupBy("doc_id", "item_id", "diagonal").agg(
        F.collect_set("item_position").alias("positions"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("bound")
    )
    run = run.where(F.size(F.array_distinct(F.transform("bound", lambda x: x["item_slots"]))) == F.size("bound"))
    run = run.withColumn("changed", F.exists("bound", lambda x: x["item_slots"] != x["slots"]))
    found = run.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("positions")))).cast("long").alias("n_windows"),
        F.min("changed").alias("reparameterised"),
    )
    found = found.join(total, "item_id").where(F.col("n_windows") >= F.col("item_windows") * COVERAGE)
    return found.select("doc_id", "item_id", "n_windows", "item_windows", "reparameterised")


def op1(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(spark, docs, benchmark)
