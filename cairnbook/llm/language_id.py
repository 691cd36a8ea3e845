"""Language identification as inference of a mixture.

A language is the relative frequencies of its character trigrams, counted over words with a space on either side. A
document is a mixture: each of its words comes from one language, with the likelihood of the word's trigrams, and
expectation-maximisation estimates the languages' proportions. Which languages a document has is decided by penalised
likelihood (BIC, words as observations): from the mixture of all, languages with less than half a word, and then the
least one at a time, go as long as the penalised likelihood doesn't fall; the best set met stands. The predicted language is the one with the largest proportion.

Trigrams are hashed to ``BUCKETS`` places, so a model is that many numbers a language, whatever the corpus; counts are
over all labelled rows, summed on the executors. A word's likelihoods may differ by ``FLOOR`` at most, so that a single
odd word decides nothing.

Null text, text without a letter, or a model without languages: ``und``, with score 0. Letters that no language has had
are equally likely in all; of equal proportions the first language by name stands. Labels that are null are not learned
from. Repeated rows count each in training and get equal predictions; an empty table has none. Long texts are read in
slabs, whole. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .shared import Scratch, prepare

UNKNOWN = "und"
BUCKETS = 1 << 16
#: Weight of the uniform distribution in a language's.
UNIFORM = 0.02
#: Greatest difference of a word's log-likelihoods.
FLOOR = 12.0
#: Penalty of a language in the mixture, in halves of the logarithm of the number of words.
PENALTY = 2.0
STEPS, SETTLED = 60, 1e-3
#: Languages that a task holds counts of at a time, and that a model may have.
HELD, MOST = 200, 2_000
#: Characters of a slab of a long text; words of several documents, and words remembered, at a time.
SLAB, PAIRS, REMEMBERED = 1_000_000, 400_000, 300_000

_WORD = re.compile(r"[^\W\d_]+")


def slabs(text: str) -> Iterator[str]:
    """Parts of about SLAB characters that cut no word."""
    at = 0
    while len(text) - at > SLAB:
        end = at + SLAB
        while end < len(text) and text[end].isalnum():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def words(text: str | None) -> Counter:
    """Runs of letters, in lower case, and how often each occurs."""
    found: Counter = Counter()
    for part in slabs(text or ""):
        found.update(_WORD.findall(part.lower()))
    for w in [w for w in found if not w.isalpha()]:  # numerals such as ² are no letters
        n = found.pop(w)
        for part in "".join(c if c.isalpha() else " " for c in w).split():
            found[part] += n
    return found


def trigrams(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words' trigrams, one for each letter, and where each word's start."""
    code = np.frombuffer(f" {' '.join(ws)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    middle = np.flatnonzero(code != 32)
    mixed = (code[middle - 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (code[middle] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (code[middle + 1] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    length = np.fromiter(map(len, ws), np.int64, len(ws))
    return (mixed >> np.uint64(48)).astype(np.int64) % BUCKETS, np.cumsum(length) - length


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a partition's labelled texts: one row per language and bucket."""
    held: dict[str, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        parts = [(lang, np.flatnonzero(n), n) for lang, n in held.items()]
        names = pa.array([x for lang, at, _ in parts for x in [lang] * len(at)], pa.string())
        join = lambda xs: pa.array(np.concatenate([np.zeros(0, np.int64), *xs]), pa.int64())
        return pa.RecordBatch.from_arrays([names, join(at for _, at, _ in parts), join(n[at] for _, at, n in parts)], ["lang", "bucket", "n"])

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            found = words(text.as_py())
            if not found:
                continue
            grams, starts = trigrams(list(found))
            often = np.repeat(np.fromiter(found.values(), np.int64, len(found)), np.diff(starts, append=len(grams)))
            counts = held.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
            np.add.at(counts, grams, often)
            if len(held) > HELD:
                yield rows()
                held.clear()
    yield rows()


class Model:
    """Log-likelihoods of trigram buckets in each language: names in order, and an array of bucket by language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        share = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        self.log = np.log((1 - UNIFORM) * share + UNIFORM / BUCKETS).T.astype(np.float32)
        self._known: dict[str, int] = {}
        self._rows = np.zeros((0, len(names)), np.float32)

    def likelihoods(self, ws: list[str]) -> np.ndarray:
        """Of each word in each language, less the greatest; words met before are remembered."""
        if len(self._known) > REMEMBERED:
            self._known, self._rows = {}, self._rows[:0]
        new = [w for w in dict.fromkeys(ws) if w not in self._known]
        if new:
            grams, starts = trigrams(new)
            found = np.add.reduceat(self.log[grams], starts, axis=0)
            found = np.maximum(found - found.max(axis=1, keepdims=True), -FLOOR)
            self._known.update(zip(new, range(len(self._known), len(self._known) + len(new)), strict=True))
            self._rows = np.concatenate([self._rows, found])
        return self._rows[np.fromiter(map(self._known.__getitem__, ws), np.int64, len(ws))]


def mixture(p: np.ndarray, often: np.ndarray, start: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages and log-likelihood for each document, by expectation-maximisation.

    p: likelihood of each word by language, words of a document together from ``start``; often: how often each occurs.
    Every document is followed until its own proportions settle.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    ends = np.append(start[1:], len(p))
    n = np.add.reduceat(often, start).astype(float)
    going, rows = np.arange(len(start)), np.arange(len(p))
    for _ in range(STEPS):
        length = (ends - start)[going]
        of, at = np.repeat(going, length), np.cumsum(length) - length
        r = p[rows] * share[of]
        r *= (often[rows] / r.sum(axis=1))[:, None]
        better = np.add.reduceat(r, at, axis=0) / n[going][:, None]
        moved = np.abs(better - share[going]).max(axis=1) > SETTLED
        share[going] = better
        if not moved.any():
            break
        rows, going = rows[np.repeat(moved, length)], going[moved]
    of = np.repeat(np.arange(len(start)), ends - start)
    return share, np.add.reduceat(often * np.log((p * share[of]).sum(axis=1)), start)


def chosen(p: np.ndarray, often: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Proportions by document, 0 for languages that are not in its set."""
    docs, langs = len(start), p.shape[1]
    ends, cost = np.append(start[1:], len(p)), PENALTY * np.log(np.maximum(2, np.add.reduceat(often, start))) / 2
    alone = np.add.reduceat(often[:, None] * np.log(p), start, axis=0)
    best = np.zeros((docs, langs))
    best[np.arange(docs), alone.argmax(axis=1)] = 1.0
    value = alone.max(axis=1) - cost
    # no mixture is likelier than each word in its best language, 0 here: where that doesn't pay for a second one, one it is
    going = np.flatnonzero(-2 * cost > value)
    allowed, before = np.ones((docs, langs)), np.full(docs, -np.inf)
    while len(going) and langs > 1:
        rows = np.concatenate([np.arange(a, b) for a, b in zip(start[going], ends[going], strict=True)])
        length = (ends - start)[going]
        at = np.cumsum(length) - length
        share, fit = mixture(p[rows], often[rows], at, allowed[going])
        found = fit - allowed[going].sum(axis=1) * cost[going]
        better = found > value[going]
        best[going[better]], value[going[better]] = share[better], found[better]
        # languages with less than half a word, and else the least one, go
        own = share * np.add.reduceat(often[rows], at)[:, None]
        least = np.where(allowed[going] > 0, share, np.inf).argmin(axis=1)
        allowed[going] *= own >= 0.5
        allowed[going, least] = 0
        on = (found >= before[going]) & (allowed[going].sum(axis=1) > 1)
        before[going] = found
        going = going[on]
    return best


_RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.StringType())])


def guessed(model: Model, texts: Iterator[str | None]) -> Iterator[tuple[str, float, str]]:
    """Language, its proportion, and all languages with their proportions (``en:0.700,fr:0.300``) for each text."""

    def answers(held: list[Counter]) -> Iterator[tuple[str, float, str]]:
        some = [c for c in held if c and model.names]
        if some:
            size = np.fromiter(map(len, some), np.int64, len(some))
            often = np.fromiter((n for c in some for n in c.values()), np.int64, size.sum())
            p = np.exp(model.likelihoods([w for c in some for w in c]).astype(float))
            share = iter(chosen(p, often, np.cumsum(size) - size))
        for c in held:
            if not c or not model.names:
                yield UNKNOWN, 0.0, ""
                continue
            mine = next(share)
            order = [k for k in np.argsort(-mine, kind="stable") if mine[k] > 0]
            yield model.names[order[0]], min(1.0, float(mine[order[0]])), ",".join(f"{model.names[k]}:{mine[k]:.3f}" for k in order)

    held, pairs = [], 0
    for text in texts:
        held.append(words(text))
        pairs += len(held[-1])
        if pairs > PAIRS:
            yield from answers(held)
            held, pairs = [], 0
    yield from answers(held)


def fitted(spark: SparkSession, labelled: DataFrame) -> Model:
    """A model from rows of text and lang; the driver gets one count per language and bucket."""
    rows = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    counts = rows.mapInArrow(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = Scratch(spark, "languages").keep(counts, "counts")
    if (n := counts.select("lang").distinct().count()) > MOST:
        raise ValueError(f"{n} languages; a model has {MOST} at most")
    found = counts.toArrow()
    names, which = np.unique(np.array(found["lang"].to_pylist(), dtype=object), return_inverse=True)
    table = np.zeros((len(names), BUCKETS), np.int64)
    table[which, found["bucket"].to_numpy()] = found["n"].to_numpy()
    return Model([str(x) for x in names], table)


def identified(spark: SparkSession, df: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """df with a struct ``into``: lang, score, languages."""
    sent = spark.sparkContext.broadcast((model.names, model.log))

    @arrow_udf(_RESULT)
    def guess(texts: pa.Array) -> pa.Array:
        own = Model.__new__(Model)
        (own.names, own.log), own._known = sent.value, {}
        own._rows = np.zeros((0, len(own.names)), np.float32)
        found = list(guessed(own, (t.as_py() for t in texts)))
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.string()), strict=True)], _RESULT.names)

    return df.withColumn(into, guess(F.col(text)))


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its key as text, modulo 4, is 2. A null key counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op12(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepare(spark)
    kept = held_out(F.col("doc_id"))
    model = fitted(spark, docs.where(~kept).select("text", "lang"))
    rows = identified(spark, docs.select("doc_id", "text"), model)
    c = F.col("language")
    return rows.select("doc_id", kept.alias("held_out"), c["lang"].alias("lang_pred"), c["score"].alias("score"), c["languages"].alias("languages"))
