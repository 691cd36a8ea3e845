"""Fill-in-the-middle, language identification and hard negatives: brute force, held-out accuracy, edge cases."""

import hashlib
import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnbook.llm import fill_middle, hard_negatives, language_id, pii, queries
from cairnbook.llm.shared import prepare


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


# --- 11: fill-in-the-middle -------------------------------------------------------------------------------------------

DOC = "doc_id long, text string, fim string, form string, n string"
TEXTS = [
    (1, None), (2, ""), (3, "a"), (4, "é"), (5, "😀"), (6, "plain words only " * 9000), (7, "é😀a漢 " * 3000), (8, "has <P> in it"), (9, "has <S>"), (10, "has <M>"),
    (11, "half <P and S> of one"), (12, "<"), (13, "S>"), (14, "ééé"), (14, "ééé"), (15, "one"), (15, "another text"), (None, "nobody's text"), (None, None), (16, "<<<<P"), (17, "M><M M>"),
    *((i, f"tëxt {i} 漢字 " * (i % 7)) for i in range(20, 220)),
]


def brute_fim(key, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fim_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in TEXTS], DOC)
    found = fill_middle.transformed(docs, into="own")
    assert found.columns == [*docs.columns, "own"]
    rows = found.withColumn("back", fill_middle.restored(F.col("own.output"), F.col("own.form"))).collect()
    assert all(r.back == (r.text or "") and r.fim == "x" for r in rows)
    got = sorted(((r.doc_id, r.own.n, r.own.form, r.own.prefix_chars, r.own.middle_chars, r.own.output) for r in rows), key=repr)
    assert got == sorted(((i, *brute_fim(i, t)) for i, t in TEXTS), key=repr)
    assert {r.own.form for r in rows} == {"plain", "psm", "spm"}


def test_fim_digests(spark):
    rows = fill_middle.op11(spark.createDataFrame([(i, t, "x", "y", "z") for i, t in TEXTS], DOC)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted(((r.doc_id, r.n, r.form, r.output_sha256, r.restored_sha256) for r in rows), key=repr)
    want = [(i, n, form, sha(out), sha(t or "")) for i, t in TEXTS for n, form, _, _, out in [brute_fim(i, t)]]
    assert got == sorted(want, key=repr)
    assert fill_middle.op11(spark.createDataFrame([], DOC)).collect() == []


def test_runs_find_every_cut():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("aé漢😀") * rng.randrange(1, 5) for _ in range(rng.randrange(12)))
        runs = fill_middle.encoded(np.frombuffer(text.encode(), np.uint8))
        assert len(runs.width) == len(list(itertools.groupby(text, lambda c: len(c.encode()))))
        for cut in range(len(text) + 1):
            assert fill_middle.byte_of(runs, cut) == len(text[:cut].encode())


# --- 12: language identification --------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_language_id"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id][0] for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fitted(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 700"))


def test_language_counts_against_brute_force(spark):
    texts = [("Ab ab²cd", "x"), ("été", "y"), ("ab", "x"), (None, "x"), ("gone", None), ("12", "y")]
    got = language_id.fitted(spark, spark.createDataFrame(texts, "text string, lang string"))
    counts = {"x": np.zeros(language_id.BUCKETS), "y": np.zeros(language_id.BUCKETS)}
    for lang, word in (("x", "ab"), ("x", "ab"), ("x", "cd"), ("x", "ab"), ("y", "été")):
        for g in language_id.trigrams([word])[0]:
            counts[lang][g] += 1
    assert got.names == ["x", "y"]
    assert np.allclose(got.log, language_id.Model(["x", "y"], np.stack([counts["x"], counts["y"]])).log)


def test_language_sets_against_all_sets(spark, model):
    """The set found is as good as the best of all sets by penalised likelihood, with plain Python for the steps."""
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 700 and lang is not null").orderBy("doc_id").collect()]
    several = [f"{a[:600]} {b[:900]}" for a, b in zip(docs[::2], docs[1::2], strict=False)] + docs[:20]
    for text, (_, _, languages) in zip(several, language_id.guessed(model, iter(several)), strict=True):
        found = language_id.words(text)
        if not found:
            continue
        p, n = np.exp(model.likelihoods(list(found)).astype(float)), sum(found.values())

        def value(of, p=p, found=found, n=n):
            share = dict.fromkeys(of, 1 / len(of))
            for _ in range(200):
                new = dict.fromkeys(of, 0.0)
                for row, often in zip(p, found.values(), strict=True):
                    whole = sum(share[k] * row[k] for k in of)
                    for k in of:
                        new[k] += often * share[k] * row[k] / whole / n
                done = max(abs(new[k] - share[k]) for k in of) < 1e-4
                share = new
                if done:
                    break
            fit = sum(often * math.log(sum(share[k] * row[k] for k in of)) for row, often in zip(p, found.values(), strict=True))
            return fit - language_id.PENALTY * math.log(max(2, n)) / 2 * len(of)

        sets = [s for size in range(1, len(model.names) + 1) for s in itertools.combinations(range(len(model.names)), size)]
        mine = tuple(sorted(model.names.index(x.split(":")[0]) for x in languages.split(",")))
        assert value(mine) >= max(value(s) for s in sets) - 0.5


def test_language_mixtures(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 700 and length(text) > 1500")
    text = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    mixed = [(f"{text[a][:3000]} {text[b][:1000]}", {a, b}) for a in text for b in text if a != b]
    for (_, both), (lang, score, languages) in zip(mixed, language_id.guessed(model, (t for t, _ in mixed)), strict=True):
        assert {x.split(":")[0] for x in languages.split(",") if float(x.split(":")[1]) > 0.1} == both and lang in both
        assert 0.6 < score < 0.9


def test_language_edges(spark, model):
    texts = [None, "", " \n\t", "12 34 ½ ²", "é", "漢字", "the " * 300_000, "x" * 2_500_000, "²the²and the", "und", "und"]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, lang string, language string")
    rows = language_id.identified(spark, docs, model, into="own").orderBy("doc_id").collect()
    assert [r.own.lang for r in rows[:4]] == ["und"] * 4 and [r.own.score for r in rows[:4]] == [0.0] * 4
    assert all(r.own.lang in model.names and 0 < r.own.score <= 1 and r.language == "b" for r in rows[4:])
    assert rows[6].own.lang == rows[8].own.lang == "en" and rows[9].own == rows[10].own
    assert language_id.op12(spark, docs.limit(0)).collect() == []
    untaught = language_id.op12(spark, docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in untaught.collect()} == {("und", 0.0)}


def test_long_texts_in_slabs(monkeypatch):
    text = " ".join(random.Random(1).choice(["été", "the", "and²x", "漢字", "7"]) for _ in range(4000))
    whole = language_id.words(text)
    monkeypatch.setattr(language_id, "SLAB", 50)
    assert language_id.words(text) == whole


# --- 13: hard negatives -----------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string"


def brute_negatives(rows):
    """By vec_id, label and whole vector, in plain Python; an id counts once for a window, with its best score in it."""
    ready = []
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        ready.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in e)))
    out = []
    for a in sorted({i for i, *_ in ready if i % 100 == 0}):
        _, label, v = min((r for r in ready if r[0] == a), key=lambda r: r[1:])
        same, other = {}, []
        for i, other_label, w in ready:
            if len(w) != len(v) or (other_label == label and i == a):
                continue
            score = sum(x * y for x, y in zip(v, w, strict=True))
            if other_label == label:
                same[i] = max(score, same.get(i, score))
            else:
                other.append((score, i))
        for p, ps in sorted(same.items(), key=lambda x: (-x[1], x[0]))[:5]:
            fit = {}
            for s, i in other:
                if 80 * ps <= 100 * s <= 100 * ps:
                    fit[i] = max(s, fit.get(i, s))
            best = sorted(fit.items(), key=lambda x: (-x[1], x[0]))[:5]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(best)]
    return sorted(out)


def vectors(n, length, seed, spread):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(10, length))
    for i in range(n):
        yield i * 5, [float(np.float32(x)) for x in (centre[i % 3] + rng.normal(size=length)) * spread(rng)], int(rng.integers(4))


CASES = {
    "norms": list(vectors(400, 8, 1, lambda rng: rng.choice([0.01, 0.3, 1.0, 5.0]))),
    "ties": [(i, [0.1 * (i % 3), 0.25, -0.125], i % 4) for i in range(0, 900, 3)] + [(100 * i, [0.5, 0.5, 0.5], i % 2) for i in range(9)],
    "odd": [
        *vectors(200, 4, 2, lambda rng: 0.5), *((i, [0.0] * 4, i % 3) for i in range(1000, 1400, 20)), *((i, [1.0, 0.5], i % 3) for i in range(2000, 2600, 25)),
        (3000, None, 1), (3001, [1.0, None, 0.0, 0.0], 1), (3100, [float("nan")] * 4, 1), (3200, [float("inf"), 0.0, 0.0, 0.0], 1), (3300, [1.0] * 4, None), (None, [1.0] * 4, 1),
        (3400, [], 1), (3401, [], 1), (3402, [], 2), (200, [0.25] * 4, 3), (5, [0.5] * 4, 0), (5, [0.5] * 4, 0), (10, [0.5] * 4, 1), (10, [0.75] * 4, 1), (3500, [-1e9] * 4, 1), (3501, [1e5] * 4, 1),
    ],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_negatives_against_brute_force(spark, name):
    frame = spark.createDataFrame([(i, e, label, "x", "y") for i, e, label in CASES[name]], VECTORS).repartition(5)
    got = sorted(tuple(r) for r in hard_negatives.op13(spark, frame).collect())
    assert got == brute_negatives(CASES[name])


def test_negatives_in_waves(spark, monkeypatch):
    rows = CASES["norms"]
    monkeypatch.setattr(hard_negatives, "CELLS", 300)
    frame = spark.createDataFrame([(i, label, [float(math.floor(256 * x)) for x in e]) for i, e, label in rows], "id long, label long, v array<double>").repartition(3)
    got = hard_negatives.mined(spark, frame, frame.where("id % 50 = 0"), wave=9)
    whole = hard_negatives.mined(spark, frame, frame.where("id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) != []


def test_negatives_edges(spark):
    empty = hard_negatives.op13(spark, spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and [n for n, _ in empty.dtypes] == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert hard_negatives.op13(spark, spark.createDataFrame([(1, [1.0], 1, "", "")], VECTORS)).collect() == []


def test_skipped_buckets():
    """Rows that no anchor can use are skipped: their products are not computed."""
    seen = []
    anchors = {2: hard_negatives.Anchors(np.array([0]), np.array([1]), np.array([0]), np.array([5.0]), np.array([[3.0, 4.0]]))}
    rows = hard_negatives.Rows(np.array([7]), np.array([1]), np.array([2.0]), np.array([[2.0, 0.0]]))
    fits = lambda own, a, r: seen.append(1) or np.ones((len(a), len(r.ids)), bool)
    assert list(hard_negatives.hits_of(anchors, rows, 2, np.array([11]), fits)) == [] and not seen
    assert len(list(hard_negatives.hits_of(anchors, rows, 2, np.array([10]), fits))) == 1 and seen


def test_negatives_sql_is_duckdb():
    assert duckdb.sql(f"SELECT * FROM (WITH embeddings AS (SELECT 100 AS vec_id, [1.0::FLOAT] AS embedding, 1 AS label) {hard_negatives.OP13_SQL.strip().replace('WITH r AS', ', r AS', 1)})").fetchall() == []


# --- 2: IBANs before other words ---------------------------------------------------------------------------------------


def test_ibans_end_where_their_country_says(spark):
    texts = {
        "DE89370400440532013000 BIC COBADEFF": "iban:0:22", "pay NL91ABNA0417164300 2024": "iban:4:22", "GB29 NWBK 6016 1331 9268 19 AND MORE": "iban:0:27",
        "FR1420041010050500013M02606 OK": "iban:0:27", "DE89370400440532013001 BIC": "", "XY12 and DE89370400440532013000X": "", "NO9386011117947": "iban:0:15",
    }
    rows = pii.detected(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    got = {r.text: ",".join(f"{x.kind}:{x.start}:{x.end}" for x in r.pii["all"] if x.kind == "iban") for r in rows}
    assert got == texts
