"""Hard negatives by norm-bucketed search.

For each anchor, the rows of its label with the greatest inner products are its positives; for each positive, the rows of
other labels whose inner product lies in a window below the positive's are its hard negatives.

Rows lie in a table in descending order of their norm, split by range, so that any run of its rows is a bucket of near
norms. Anchors are sent to the executors in waves of bounded size and meet the buckets in that order; one matrix product
gives a bucket's scores. No inner product is greater than the product of two norms (Cauchy-Schwarz): an anchor skips a
bucket where that is below the lower limit of all its windows or, once a window has all its results, below the least of
them. Each wave starts with the rows of greatest norm; what they give is the limit that all tasks start the rest with.
The search is exact: only what can't be a result is skipped.

Rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do anchors without any
row of their label with a score of at least 0, as their windows are empty. Vectors of different lengths have no inner
product. Equal scores are ordered by id. Repeated rows, and several rows with one id, count once, with the best score in the window; of
several anchors with one id the first by label and vector stands. Vectors hold whole numbers; inner products are exact,
and one in the result that 64 bits can't hold fails the job. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, prepare

#: Anchors, and numbers in their vectors, that are sent at a time.
WAVE_ANCHORS, WAVE_NUMBERS = 50_000, 4_000_000
#: Scores computed at a time.
CELLS = 2_000_000
#: Share of the rows, those of greatest norm, that each wave begins with.
HEAD = 1 / 16
NONE = np.iinfo(np.int64).min
#: Slack on a product of two norms, for their rounding.
SLACK = 1 + 1e-9


class Anchors(NamedTuple):
    """Anchors of one vector length: where each stands in its wave, ids, labels, norms, vectors."""

    at: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    norms: np.ndarray
    vectors: np.ndarray


class Rows(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    norms: np.ndarray
    vectors: np.ndarray


def by_length(table: pa.Table | pa.RecordBatch) -> dict[int, tuple[np.ndarray, Rows]]:
    """Rows by the length of their vectors, with their places in the table."""
    column = table.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    numbers = lambda c: np.asarray(table.column(c).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(c).to_numpy())
    ids, labels, norms = numbers("id"), numbers("label"), numbers("norm")
    length = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    out, ends = {}, np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    for n in np.unique(length):
        which = np.flatnonzero(length == n)
        vectors = values.reshape(-1, n) if len(which) == len(length) and n else values[ends[which][:, None] + np.arange(n)]
        out[int(n)] = which, Rows(ids[which], labels[which], norms[which], vectors)
    return out


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles while no partial sum can reach 2^53, then in 64 bits, then in
    Python's integers."""
    if bound < 2**53:
        return a @ b.T
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a) @ whole(b).T


class Best:
    """The ``k`` best (score, id) of each group so far, best first."""

    def __init__(self, groups: int, k: int):
        self.k, self.score, self.id = k, np.full((groups, k), NONE), np.zeros((groups, k), np.int64)

    def kth(self) -> np.ndarray:
        """The least score that a group holds once it is full; before that, less than any score."""
        return self.score[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        last, last_id = self.score[group, -1], self.id[group, -1]
        enters = (score > last) | ((score == last) & (ids < last_id))
        if not enters.any():
            return
        group, score, ids = group[enters], score[enters], ids[enters]
        touched = np.unique(group)
        old = np.repeat(touched, self.k), self.score[touched].ravel(), self.id[touched].ravel()
        real = old[1] > NONE
        group, score, ids = (np.concatenate([o[real], n]) for o, n in zip(old, (group, score, ids), strict=True))
        o = np.lexsort((-score, ids, group))
        group, score, ids = group[o], score[o], ids[o]
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])])
        group, score, ids = group[fresh], score[fresh], ids[fresh]
        o = np.lexsort((ids, -score, group))
        group, score, ids = group[o], score[o], ids[o]
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        kept = place < self.k
        self.score[touched], self.id[touched] = NONE, 0
        self.score[group[kept], place[kept]], self.id[group[kept], place[kept]] = score[kept], ids[kept]

    def found(self, slots: int, anchor_ids: np.ndarray) -> pa.RecordBatch:
        group, place = np.nonzero(self.score > NONE)
        columns = {"anchor_id": anchor_ids[group // slots], "slot": group % slots, "score": self.score[group, place], "id": self.id[group, place]}
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))


HITS = "anchor_id long, slot long, score long, id long"


def hits_of(anchors: dict[int, Anchors], rows: Rows, length: int, limit: np.ndarray, fits: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor's place, row, score) of scores that reach the anchor's limit and whose labels fit, for one bucket of rows.

    limit: by the anchor's place, read anew for each part of the anchors. fits: a mask from the labels and ids of both.
    """
    if length not in anchors or not len(rows.ids):
        return
    own, greatest = anchors[length], float(rows.norms.max())
    step = max(1, CELLS // len(rows.ids))
    reach = np.flatnonzero(own.norms * (greatest * SLACK) >= limit[own.at])
    for i in range(0, len(reach), step):
        a = reach[i : i + step]
        a = a[own.norms[a] * (greatest * SLACK) >= limit[own.at[a]]]
        if not len(a):
            continue
        score = products(own.vectors[a], rows.vectors, float(own.norms[a].max()) * greatest)
        hit, row = np.nonzero((score >= limit[own.at[a]][:, None]).astype(bool) & fits(own, a, rows))
        yield own.at[a[hit]], row, score[hit, row].astype(np.int64)


def positives_of(anchors: dict[int, Anchors], ids: np.ndarray, floor: np.ndarray, k: int) -> Callable:
    """A task: the best rows of each anchor's label, apart from rows with its id."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        same = lambda own, a, rows: (own.labels[a][:, None] == rows.labels) & (own.ids[a][:, None] != rows.ids)
        for batch in batches:
            for length, (_, rows) in by_length(batch).items():
                for label in np.unique(rows.labels):  # only anchors of the label meet its rows
                    mine = rows.labels == label
                    part = Rows(*(c[mine] for c in rows))
                    of = {n: Anchors(*(c[x.labels == label] for c in x)) for n, x in anchors.items() if n == length}
                    for at, row, score in hits_of(of, part, length, np.maximum(floor, best.kth()), same):
                        best.add(at, score, part.ids[row])
        yield best.found(1, ids)

    return task


def negatives_of(anchors: dict[int, Anchors], ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Callable:
    """A task: for each window (anchor by slot) the best rows of other labels from low to high; a window without a positive
    has a low above its high."""
    slots = low.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(low.size, k)
        other = lambda own, a, rows: own.labels[a][:, None] != rows.labels
        top = high.max(axis=1)
        for batch in batches:
            for length, (_, rows) in by_length(batch).items():
                least = np.maximum(low, best.kth().reshape(low.shape))
                for at, row, score in hits_of(anchors, rows, length, least.min(axis=1), other):
                    below = score <= top[at]
                    at, row, score = at[below], row[below], score[below]
                    for slot in range(slots):
                        inside = (score >= least[at, slot]) & (score <= high[at, slot])
                        best.add(at[inside] * slots + slot, score[inside], rows.ids[row[inside]])
        yield best.found(slots, ids)

    return task


def best_first(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and slot, over all tasks, with their ranks. One shuffle serves both steps."""
    own = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    one = hits.repartition("anchor_id", "slot").groupBy("anchor_id", "slot", "id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def _limits(hits: DataFrame, ids: np.ndarray, slots: int, k: int) -> np.ndarray:
    """The k-th best score of each group of a wave; less than any where there are fewer."""
    out = np.full((len(ids), slots), NONE)
    rows = hits.where(F.col("rank") == k).select("anchor_id", "slot", "score").toArrow()
    out[np.searchsorted(ids, rows["anchor_id"].to_numpy()), rows["slot"].to_numpy()] = rows["score"].to_numpy()
    return out


def mined(spark: SparkSession, rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, wave: int = WAVE_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its
    ``positives`` best rows of its label, the ``negatives`` best rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score.

    rows, anchors: id (long), label (whole number), v (array of doubles with whole values). 0 <= low <= high.
    """
    prepare(spark)
    scratch = Scratch(spark, "negatives")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    known = "id is not null and label is not null and v is not null"
    rows = rows.where(known).select("id", F.col("label").cast("long").alias("label"), "v", norm.alias("norm"))
    rows = scratch.keep(rows.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id"), "rows")
    # the columns that come from a row, in their order, decide between anchors with one id
    one = anchors.where(known).groupBy("id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "v")).alias("o"))
    anchors = scratch.keep(one.select("id", "o.*").withColumn("norm", norm), "anchors")
    size = anchors.agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("numbers")).first()
    theta = rows.agg(F.percentile_approx("norm", 1 - HEAD, 1000)).first()[0]
    if not size.n or theta is None:
        return spark.createDataFrame([], RESULT)
    waves = max(math.ceil(size.n / wave), math.ceil((size.numbers or 0) / WAVE_NUMBERS))
    done: list[str] = []
    for w in range(waves):
        sent = anchors.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == w).orderBy("id").toArrow()
        if sent.num_rows:
            ready = {n: Anchors(at, *part) for n, (at, part) in by_length(sent).items()}
            found = _wave(spark, scratch, f"{w}", rows, theta, ready, sent["id"].to_numpy(), positives, negatives, low, high)
            scratch.keep(found, f"{w}-mined")
            done.append(scratch.path(f"{w}-mined"))
    return spark.read.schema(RESULT).parquet(*done)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _wave(spark: SparkSession, scratch: Scratch, name: str, rows: DataFrame, theta: float, anchors: dict[int, Anchors], ids: np.ndarray, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The results of one wave of anchors: two searches, each over the rows of greatest norm, then over those of the rest
    that can still reach a limit."""
    norms = np.zeros(len(ids))
    for x in anchors.values():
        norms[x.at] = x.norms

    def searched(step: str, task: Callable, part: DataFrame) -> DataFrame:
        return scratch.keep(part.mapInArrow(task, HITS), f"{name}-{step}")

    def both(step: str, slots: int, k: int, floor: np.ndarray, make: Callable) -> DataFrame:
        """floor: the least score of use, by anchor and slot. make: a task for such a floor."""
        first = scratch.keep(best_first(searched(f"{step}-head", make(floor), rows.where(F.col("norm") >= theta)), k), f"{name}-{step}-first")
        floor = np.maximum(floor, _limits(first, ids, slots, k))
        least = floor.min(axis=1)
        # no row of a lesser norm reaches any anchor's limit: the scan skips what lies below, by the files' statistics
        reach = np.divide(least, norms, out=np.where(least > 0, np.inf, 0.0), where=norms > 0).min() / SLACK
        rest = searched(f"{step}-rest", make(floor), rows.where((F.col("norm") < theta) & (F.col("norm") >= max(0.0, float(reach)))))
        return best_first(first.select(rest.columns).unionByName(rest), k)

    zero = np.zeros((len(ids), 1), np.int64)
    liked = both("positives", 1, positives, zero, lambda floor: positives_of(anchors, ids, floor[:, 0], positives))
    liked = liked.select("anchor_id", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    liked = scratch.keep(liked, f"{name}-liked")
    best = liked.toArrow()
    at, slot, score = np.searchsorted(ids, best["anchor_id"].to_numpy()), best["slot"].to_numpy(), best["positive_score"].to_numpy()
    least, most = np.full((len(ids), positives), np.iinfo(np.int64).max), np.full((len(ids), positives), NONE)
    least[at, slot], most[at, slot] = -((-low * score.astype(object)) // 100), (high * score.astype(object)) // 100
    found = both("negatives", positives, negatives, least, lambda floor: negatives_of(anchors, ids, floor, most, negatives))
    found = found.select("anchor_id", "slot", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(liked, ["anchor_id", "slot"]).select([x.split()[0] for x in RESULT.split(", ")])


def quantised(x: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) for each component, as a double; from 2^52 on a double is whole."""
    part = lambda c: c.cast("double") * scale
    return F.transform(x, lambda c: F.when(F.abs(part(c)) < 2.0**52, F.floor(part(c)).cast("double")).otherwise(part(c)))


def op13(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("v"))
    return mined(spark, rows, rows.where("id % 100 = 0"))


OP13_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
liked AS (SELECT anchor_id, id, score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM liked p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
