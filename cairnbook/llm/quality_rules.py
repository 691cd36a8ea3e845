"""Quality rules by repetition coverage.

For each text, rolling hashes of several n-gram lengths find n-grams and lines that occur more than once in it; the
share of its characters inside them decides, besides the base rules (too few words, or over 30 % of the words in
repeated 8-word windows). Longer n-grams are only looked for in texts with a repeated n-gram of the shortest length.

Null or empty text: no words, so it fails the base rule and is not kept. Rows with equal text get equal results, each
row on its own; very long texts are judged whole. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from . import rolling

BASE_NGRAM = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
NGRAMS = (5, 6, 7, 8, 9, 10)
#: Largest share of the word characters inside repeated n-grams or lines, in percent.
MAX_NGRAM_PERCENT = 40
MAX_LINE_PERCENT = 40

FIELDS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "dup_ngram_chars",
    "dup_line_chars",
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The seven counts of FIELDS for each text."""
    n = len(offsets) - 1
    start, end, doc = rolling.words(data, offsets)
    points = rolling.code_points_before(data)
    length = points[end] - points[start]
    count = lambda which, weights=None: np.bincount(which, weights, n).astype(np.int64)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    token = rolling.hash_spans(data, start, end)
    salt = rolling.mix(np.arange(n, dtype=np.uint64))
    repeat_words, ngram_chars = np.zeros(n, np.int64), np.zeros(n, np.int64)
    suspect = np.ones(n, bool)
    for size in NGRAMS:
        mine = np.flatnonzero(suspect[doc])
        own = doc[mine]
        at, window = rolling.hash_windows(token[mine], own, size)
        again = at[rolling.repeated(window ^ salt[own[at]])]
        inside = mine[rolling.covered(again, size, len(mine))]
        if size == NGRAMS[0]:
            suspect = np.zeros(n, bool)
            suspect[doc[inside]] = True
        if size == BASE_NGRAM:
            repeat_words = count(doc[inside])
        ngram_chars = np.maximum(ngram_chars, count(doc[inside], length[inside]))

    line_start, line_end, line_doc = rolling.runs(data != 10, offsets)
    ink = np.concatenate([[0], np.cumsum(~rolling.SPACE[data], dtype=np.int64)])
    full = ink[line_end] > ink[line_start]
    line_start, line_end, line_doc = line_start[full], line_end[full], line_doc[full]
    line = rolling.hash_spans(data, line_start, line_end)
    again = rolling.repeated(line ^ salt[line_doc], later_only=True)
    word_points = np.concatenate([[0], np.cumsum(~rolling.SPACE[data] & ((data & 0xC0) != 0x80), dtype=np.int64)])
    line_chars = word_points[line_end] - word_points[line_start]
    return [
        count(doc),
        count(doc, length),
        n_symbols,
        count(line_doc[again]),
        repeat_words,
        ngram_chars,
        count(line_doc[again], line_chars[again]),
    ]


@arrow_udf(T.StructType([T.StructField(x, T.LongType()) for x in FIELDS]))
def _measure(texts: pa.Array) -> pa.Array:
    parts = [measure(*chunk) for chunk in rolling.chunks(texts)]
    columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(FIELDS))]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(FIELDS))


def quality(text: Column) -> Column:
    """A struct of the counts, ``base_failed`` and ``kept`` for a text column."""
    return _measure(text)


def verdict(df: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """df with a struct column ``into``: the counts, base_failed, kept."""
    m = F.col(into)
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    heavy = (100 * m["dup_ngram_chars"] > MAX_NGRAM_PERCENT * m["word_chars"]) | (
        100 * m["dup_line_chars"] > MAX_LINE_PERCENT * m["word_chars"]
    )
    df = df.withColumn(into, quality(F.col(text)))
    return df.withColumn(into, m.withField("base_failed", failed).withField("kept", ~failed & ~heavy))


def op3(docs: DataFrame) -> DataFrame:
    return verdict(docs.select("doc_id", "text")).select("doc_id", "quality.*")
