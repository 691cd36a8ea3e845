"""Near-duplicate documents by bottom-k sketches.

A document's set is the hashes of its distinct 5-word shingles (ASCII letters lower-cased); with fewer words, the whole
sequence is its one shingle. One hash function serves all: the k smallest values of a set are its sketch.

1. Documents with equal sets form a class, at no cost in pairs; from here on classes are compared.
2. Inverted lists: each class is listed under its smallest retained values; lists of up to ``HOT`` classes generate
   pairs, and how often a pair meets is its overlap, which must be a quarter of what the one with fewer such values has.
   A value of more than ``HOT`` sketches is hot (a passage that many documents share, or a large group of near copies)
   and generates no pairs of this kind.
3. Classes with more than a quarter of hot values (warm) could miss each other that way. They get sketches of ``WIDE``
   values and are listed again, under the smallest of these that are not hot: texts that share a long passage meet by
   what else they say. What then has fewer than ``VERY_HOT`` percent of values that are not hot is part of a large group of near
   copies, and is listed under its smallest hot values. In such a list, a few pivots (first those with the fewest values
   of their own: the original of a group of copies has none) are compared with all members, and never need to be again;
   members that are not alike enough to the first pivot can't be linked with what is linked to it, as one minus the
   similarity is a distance, so the list is split; lists that have become one component are done. Lists of up to
   ``BLOCK`` classes are compared whole in one task; so are, block by block, lists that pivots don't shorten.
4. The union of two sketches estimates the similarity of a pair; pairs well below the threshold go.
5. Whole texts decide: 100 * intersection >= percent * union, on the full sets.
6. Components of the links by alternating large-star and small-star steps.

Every step is a join or aggregate whose rows follow the input; no group is collected. Intermediate tables lie in the
shared folder, so lost executors cost a task, not the run.

Null or empty texts, and texts without words, have no set: they are linked with nothing and are their own component.
Rows with the same id count as one node that has the links of any of them; rows with a null id have component null and
are kept. Other columns pass through ``mark``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from . import rolling
from .shared import Scratch, prepare, sent_if_small

SHINGLE = 5
PERCENT = 85
#: Values retained in a sketch; of these, how many list a class; longest list that generates pairs.
SKETCH, LISTED, HOT = 32, 24, 64
#: Share of hot values, in percent, above which a class is warm; values in the sketch of a warm class, and how many of
#: those that are not hot list it; share of such values, in percent, below which it is also listed under hot ones.
PARTLY_HOT, WIDE, WIDE_LISTED, VERY_HOT = 25, 256, 48, 30
#: Of a list of hot values: values that list a class, classes in a block, pivots of a round.
HOT_LISTED, BLOCK, PIVOTS = 5, 256, 4
#: A pair goes on if its estimate is at most this much below the threshold (over 4.5 standard errors of the estimate).
SLACK = 0.3


def sets_of(texts: pa.Array):
    """The sorted shingle set of each text, in order."""
    for data, offsets in rolling.chunks(texts):
        data = rolling.LOWER[data]
        start, end, doc = rolling.words(data, offsets)
        token = rolling.hash_spans(data, start, end)
        at, window = rolling.hash_windows(token, doc, SHINGLE)
        n = len(offsets) - 1
        first = np.searchsorted(doc, np.arange(n + 1))
        cut = np.searchsorted(doc[at], np.arange(n + 1))
        for i in range(n):
            if cut[i + 1] > cut[i]:
                yield np.unique(window[cut[i] : cut[i + 1]].view(np.int64))
            elif first[i + 1] > first[i]:
                own = token[first[i] : first[i + 1]]
                yield rolling.hash_windows(own, np.zeros(len(own), np.int64), len(own))[1].view(np.int64)
            else:
                yield np.zeros(0, np.int64)


_SIGNATURE = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("n_shingles", "h1", "h2")]
    + [T.StructField("sketch", T.ArrayType(T.LongType()))]
)


@arrow_udf(_SIGNATURE)
def _signature(texts: pa.Array) -> pa.Array:
    n, h1, h2, sketches, ends = [], [], [], [], [0]
    for own in sets_of(texts):
        u = own.view(np.uint64)
        n.append(len(own))
        h1.append(int(rolling.mix(u).sum(dtype=np.uint64).astype(np.int64)) if len(u) else 0)
        h2.append(int(rolling.mix(u ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).astype(np.int64)) if len(u) else 0)
        sketches.append(own[:SKETCH])
        ends.append(ends[-1] + len(sketches[-1]))
    values = pa.array(np.concatenate(sketches) if sketches else np.zeros(0, np.int64), pa.int64())
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
        ["n_shingles", "h1", "h2", "sketch"],
    )


@arrow_udf(T.StructType([T.StructField("common", T.LongType()), T.StructField("united", T.LongType())]))
def _compare(a: pa.Array, b: pa.Array) -> pa.Array:
    """Sizes of intersection and union of the full sets of two texts."""
    common, united = [], []
    for x, y in zip(sets_of(a), sets_of(b), strict=True):
        same = len(np.intersect1d(x, y, assume_unique=True))
        common.append(same)
        united.append(len(x) + len(y) - same)
    return pa.StructArray.from_arrays([pa.array(common, pa.int64()), pa.array(united, pa.int64())], ["common", "united"])


@arrow_udf(T.ArrayType(T.LongType()))
def _wide(texts: pa.Array) -> pa.Array:
    """The ``WIDE`` smallest values of each text's set."""
    sketches = [own[:WIDE] for own in sets_of(texts)]
    ends = np.cumsum([0, *map(len, sketches)])
    values = np.concatenate([np.zeros(0, np.int64), *sketches])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def estimate(a: Column, b: Column, size: int = SKETCH) -> Column:
    """The share of the smallest values of the union of two sketches that both hold."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def _sized(left: str = "n_a", right: str = "n_b", *, percent: int) -> Column:
    """Sets so different in size that they can't be similar enough are out."""
    a, b = F.col(left), F.col(right)
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for edges (a, b): component is the smallest node reachable.

    Smallest neighbours are aggregated and written before edges are joined with them, so that a node with very many edges
    is no single task: the join is a broadcast or, of many nodes, one that Spark can split.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = scratch.keep(edges, f"edges-0")
    state, step = None, 0
    while True:
        step += 1
        # large star: every larger neighbour of u goes to u's smallest neighbour (or u)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"least-{step}")
        large = both.where("v > u").join(sent_if_small(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = scratch.keep(large, f"large-{step}")
        # small star: u and its smaller neighbours go to the smallest of them
        least = scratch.keep(large.groupBy("u").agg(F.min("v").alias("m")), f"least-{step}s")
        small = large.join(sent_if_small(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        small = scratch.keep(small, f"edges-{step}")
        scratch.drop(f"edges-{step - 1}", f"large-{step}", f"least-{step}", f"least-{step}s")
        now = small.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        edges = small
        if now == state or not now[0]:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        state = now


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) with the sizes of intersection and union of their full sets."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", _compare("text_a", "text_b").alias("c")).select("a", "b", "c.*")


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= F.col("united") * percent


def _pairs_of_lists(listed: DataFrame, percent: int, share: int = 4) -> DataFrame:
    """Pairs (a < b) of classes that share enough lists: one of ``share`` of those that the one in fewer is in."""
    left = listed.select("value", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("listed").alias("l_a"))
    right = listed.select("value", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("listed").alias("l_b"))
    met = left.join(right, "value").where((F.col("a") < F.col("b")) & _sized(percent=percent))
    met = met.groupBy("a", "b").agg(F.count("*").alias("overlap"), F.first("l_a").alias("l_a"), F.first("l_b").alias("l_b"))
    return met.where(F.col("overlap") * share >= F.least("l_a", "l_b")).select("a", "b")


def forest(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets of shingles; with two sides, of the links from one to the other."""
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    value, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    column = np.full(len(value), -1, np.int64)
    column[shared] = np.arange(len(shared))
    column = column[where]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(shared), 4096):
        mine = (column >= first) & (column < first + 4096)
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[mine], column[mine] - first] = 1
        common += held @ held.T
    common = common.astype(np.int64)
    linked = common * 100 >= (size[:, None] + size[None, :] - common) * percent
    if side.min() != side.max():
        linked &= side[:, None] != side[None, :]
    parent, out = list(range(len(sets))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in np.argwhere(np.triu(linked, 1)).tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[b] = a
            out.append((i, j))
    return out


def _links_in_blocks(lists: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links among classes in one list of any length, block by block."""
    sizes = lists.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = lists.join(sizes, "value").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    dealt = dealt.select("value", "id", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("value", "id", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(rows: pa.Table) -> pa.Table:
        ids, found = rows.column("id").to_pylist(), []
        if len(ids) > 1:
            found = forest(list(sets_of(rows.column("text"))), rows.column("block").to_numpy(), percent)
        pairs = [(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in found if ids[i] != ids[j]]
        return pa.table({"a": pa.array([x[0] for x in pairs], pa.int64()), "b": pa.array([x[1] for x in pairs], pa.int64())})

    return dealt.join(texts, "id").groupBy("value", "low", "high").applyInArrow(compare, "a long, b long").distinct()


#: Comparisons with one pivot that one salt takes.
COMPARED = 256


def _against_pivots(pairs: DataFrame, pivots: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (pivot, id) with the sizes of intersection and union; a pivot's text goes out once for each ``COMPARED``
    members of the lists it is a pivot of, so that its tasks stay small however long they are."""
    salts = pivots.groupBy("pivot").agg(F.ceil(F.sum("members") / COMPARED).cast("int").alias("salts"))
    salts = sent_if_small(salts)
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    left = texts.select(F.col("id").alias("pivot"), F.col("text").alias("text_a")).join(salts, "pivot").select("pivot", "text_a", salt)
    salt = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")
    both = pairs.join(salts, "pivot").select("pivot", "id", salt.alias("salt")).join(texts, "id").join(left, ["pivot", "salt"])
    return both.select("pivot", "id", _compare("text_a", "text").alias("c")).groupBy("pivot", "id").agg(F.max("c").alias("c")).select("pivot", "id", "c.*")


def _links_of_hot(lists: DataFrame, texts: DataFrame, known: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links (a, b) that join up the classes of lists of any length (value, id, own: how many values it has that are not
    hot); known: links among them that are already found."""
    links, rest, before, step = known, [], None, 0
    while True:
        labels = scratch.keep(components(links, scratch), f"labels-{step}")
        state = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        sizes = state.groupBy("value").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
        sizes = scratch.keep(sizes.where("low < high").select("value", "members"), f"sizes-{step}")
        state = scratch.keep(state.join(sent_if_small(sizes), "value"), f"state-{step}")
        long = state.where(F.col("members") > BLOCK)
        now = long.count()
        stuck = before is not None and now > before * 0.75
        rest.append(state.where(F.lit(True) if stuck else F.col("members") <= BLOCK).select("value", "id"))
        if stuck or not now:
            break
        before, step = now, step + 1
        order = [F.col("own"), F.xxhash64("id")]
        if step % 2 == 0:  # now those that few others are linked with
            alone = long.groupBy("value", "component").agg(F.count("*").alias("with"))
            long, order = long.join(alone, ["value", "component"]), [F.col("with"), *order]
        rank = F.row_number().over(Window.partitionBy("value").orderBy(*order))
        pivots = long.withColumn("rank", rank).where(F.col("rank") <= PIVOTS)
        pivots = scratch.keep(pivots.select("value", F.col("id").alias("pivot"), F.col("component").alias("of"), "rank", "members"), f"pivots-{step}")
        met = long.drop("members").join(sent_if_small(pivots), "value").where((F.col("id") != F.col("pivot")) & ((F.col("rank") == 1) | (F.col("component") != F.col("of"))))
        compared = scratch.keep(_against_pivots(met.select("pivot", "id").distinct(), pivots, texts), f"compared-{step}")
        found = compared.where(_linked(percent)).select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b"))
        links = scratch.keep(links.unionByName(found).distinct(), f"hot-links-{step}")
        # split the lists by their first pivots; pivots are done
        first = pivots.where("rank = 1").select("value", "pivot")
        left = long.select("value", "id", "own").join(pivots.select("value", F.col("pivot").alias("id")), ["value", "id"], "left_anti")
        placed = left.join(sent_if_small(first), "value").join(compared, ["pivot", "id"])
        near = F.col("common") * 100 >= F.col("united") * (2 * percent - 100)
        placed = scratch.keep(placed.select("value", "id", "own", _linked(percent).alias("linked"), near.alias("near")), f"placed-{step}")
        counts = placed.groupBy("value").agg(F.count_if("linked").alias("n_linked"), F.count_if(~F.col("near")).alias("n_far"))
        both = placed.join(sent_if_small(counts), "value")
        close = both.where("near and n_linked > 0").select(F.xxhash64("value", F.lit(2 * step)).alias("value"), "id", "own")
        apart = both.where("not linked and (n_linked = 0 or n_far > 0)").select(F.xxhash64("value", F.lit(2 * step + 1)).alias("value"), "id", "own")
        lists = scratch.keep(close.unionByName(apart), f"lists-{step}")
    for lists in rest:
        links = links.unionByName(_links_in_blocks(lists, texts, percent))
    return links.distinct()


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int, size: int = SKETCH) -> DataFrame:
    """The pairs whose sketches leave the threshold possible."""
    left = reps.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
    right = reps.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(estimate(F.col("sketch_a"), F.col("sketch_b"), size) >= percent / 100 - SLACK).select("a", "b")


def _hot_values(sketches: DataFrame) -> DataFrame:
    return sketches.select(F.explode("sketch").alias("value")).groupBy("value").count().where(F.col("count") > HOT).select("value")


def _cool(values: DataFrame, hot: DataFrame) -> DataFrame:
    """(id, n, cool): the values of each class (id, n, value) that are not hot, in order."""
    return values.join(hot, "value", "left_anti").groupBy("id", "n").agg(F.array_sort(F.collect_list("value")).alias("cool"))


def _listed(cool: DataFrame, most: int) -> DataFrame:
    """(value, id, n, listed): the classes under their ``most`` smallest values that are not hot."""
    own = F.slice("cool", 1, most)
    return cool.select(F.explode(own).alias("value"), "id", "n", F.size(own).alias("listed"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id, kept. percent: similarity from which texts are linked."""
    prepare(spark)
    scratch = Scratch(spark, "minhash")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sig = scratch.keep(source.select("id", _signature("text").alias("s")).select("id", "s.*"), "signatures")
    keyed = ["n_shingles", "h1", "h2"]
    classes = sig.where("n_shingles > 0 and id is not null").groupBy(*keyed).agg(F.min("id").alias("rep"))
    classes = scratch.keep(classes, "classes")
    reps = sig.join(classes, keyed).where("id = rep").select("id", F.col("n_shingles").alias("n"), "sketch")
    reps = scratch.keep(reps, "reps")

    hot = scratch.keep(_hot_values(reps), "hot")
    listed = F.slice("sketch", 1, LISTED)
    cool = scratch.keep(_cool(reps.select("id", "n", F.explode(listed).alias("value")), hot), "cool")
    pairs = _estimated(_pairs_of_lists(_listed(cool, LISTED), percent), reps, percent)
    pairs = scratch.keep(pairs, "pairs")

    none = F.array().cast("array<long>")
    warm = reps.select("id", "n", F.size(listed).alias("listed")).join(cool, ["id", "n"], "left")
    warm = warm.where((F.col("listed") - F.size(F.coalesce("cool", none))) * 100 > F.col("listed") * PARTLY_HOT)
    warm = sent_if_small(scratch.keep(warm.select("id").distinct(), "warm"))
    wide = source.join(warm, "id", "left_semi").select("id", _wide("text").alias("sketch"))
    wide = wide.join(sig.select("id", F.col("n_shingles").alias("n")).distinct(), "id")
    # only then filtered: a filter on the function's result would be pushed below the semi-join, to all documents
    wide = scratch.keep(wide, "wide").where(F.size("sketch") > 0)
    hot = scratch.keep(_hot_values(wide), "wide-hot")
    cool = scratch.keep(_cool(wide.select("id", "n", F.explode("sketch").alias("value")), hot), "wide-cool")
    met = scratch.keep(_pairs_of_lists(_listed(cool, WIDE_LISTED), percent, share=8), "met")
    pairs = scratch.keep(pairs.unionByName(_estimated(met, wide, percent, WIDE)).distinct(), "all-pairs")

    very = wide.join(cool, ["id", "n"], "left").withColumn("cool", F.coalesce("cool", none))
    very = very.where(F.size("cool") * 100 < F.size("sketch") * VERY_HOT)
    values = F.slice(F.array_except("sketch", "cool"), 1, HOT_LISTED)
    lists = very.select(F.explode(values).alias("value"), "id", F.size("cool").alias("own")).groupBy("value", "id").agg(F.min("own").alias("own"))
    lists = scratch.keep(lists, "lists")
    members = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(lists.select("id")).distinct()
    members = sent_if_small(scratch.keep(members, "members"))
    texts = scratch.keep(source.join(members, "id", "left_semi"), "texts")
    links = scratch.keep(_verified(pairs, texts).where(_linked(percent)).select("a", "b"), "links")
    ids = sent_if_small(scratch.keep(lists.select("id").distinct(), "very-hot"))
    known = links.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b")
    links = scratch.keep(links.unionByName(_links_of_hot(lists, texts, known, scratch, percent)).distinct(), "all-links")
    scratch.drop("pairs", "all-pairs", "met", "texts", "reps", "cool", "wide", "wide-cool")
    labels = scratch.keep(components(links, scratch), "components")
    out = sig.select("id", *keyed).join(classes, keyed, "left")
    out = out.join(labels, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(spark, docs)
