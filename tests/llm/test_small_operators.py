"""Each operator on small tables: against brute force, and with nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns whose names clash with its own."""

import base64
import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairnbook.llm import (
    decontamination,
    html_extract,
    minhash_dedup,
    packing,
    pii,
    preference_format,
    quality_rules,
    queries,
    repeat_spans,
    rolling,
    url_filter,
    warc,
)
from cairnbook.llm.shared import Scratch, prepare

DOC = "doc_id long, text string, kept string, quality string, pii string, n_words string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "k", "q", "p", "n") for i, t in texts], DOC)


def words(n, seed):
    rng = random.Random(seed)
    return [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(n)]


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "x" * 120_000), (6, "é😀 " * 3000), (7, "same line\n" * 40), (7, "same line\n" * 40), (None, "nobody " * 30)]


# --- 3: quality rules -------------------------------------------------------------------------------------------------


def brute_quality(text):
    ws = re.findall(r"[^ \t-\r]+", text or "")
    grams = collections.Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = {j for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^ \t-\r]", line):
            lines += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered)


def test_quality_against_brute_force(spark):
    texts = [*EDGES, *((100 + i, " ".join(words(60, i) + words(60, i % 3))) for i in range(12)), (200, "a # b | c\r\nx\n\nx\n")]
    got = quality_rules.op3(documents(spark, texts)).collect()
    want = sorted(repr((i, *brute_quality(t))) for i, t in texts)
    assert sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    out = quality_rules.verdict(documents(spark, texts), into="verdict")
    assert out.columns[:6] == documents(spark, texts).columns and out.count() == len(texts)
    assert quality_rules.op3(documents(spark, [])).collect() == []


# --- 6: near-duplicates -----------------------------------------------------------------------------------------------


def brute_components(texts, percent=85):
    def shingles(text):
        ws = re.findall(r"[^ \t-\r]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())

    sets = [(i, shingles(t)) for i, t in texts if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}, {i: len(s) for i, s in sets}


def near_copies():
    texts = []
    for g in range(6):
        base = words(120, g)
        for k in range(5):
            w = list(base)
            for e in range(k):
                w[(17 * e + 11 * k) % 120] = f"new{g}{k}{e}"
            texts.append((1000 + g * 10 + k, " ".join(w)))
    passage = words(60, 99)
    texts += [(1100 + i, " ".join(words(50, 100 + i) + passage)) for i in range(12)]
    return texts


@pytest.mark.parametrize("hot", [64, 3])
def test_near_duplicates_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(minhash_dedup, "HOT", hot)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    texts = [*EDGES, *near_copies(), (300, "Tiny text"), (299, "tiny TEXT")]
    components, sizes = brute_components(texts)
    for r in minhash_dedup.op6(spark, documents(spark, texts)).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], components[r.doc_id], components[r.doc_id] == r.doc_id)
    assert minhash_dedup.op6(spark, documents(spark, [])).collect() == []


def test_near_duplicates_that_share_a_hot_passage(spark):
    passage, texts = words(420, 77), []  # hot: more than HOT texts have it
    for seed in (6031, 6067, 6252, 6317):  # of their 24 listed values, 12 and 15 to 18 are hot, and at most 5 others common
        own = words(280, seed)
        texts += [(seed, " ".join(passage + own)), (seed + 1, " ".join(passage + own[:183]))]
    texts += [(i, " ".join(passage + words(280, i))) for i in range(60)]
    components, _ = brute_components(texts)
    assert [i for i, c in components.items() if i != c] == [6032, 6068, 6253, 6318]
    got = {r.doc_id: r.component_id for r in minhash_dedup.op6(spark, documents(spark, texts)).collect()}
    assert got == components


@pytest.mark.parametrize("compared", [256, 7])
def test_near_duplicates_in_large_groups(spark, monkeypatch, compared):
    """Two families of near copies that share half of their text, all values hot; most are linked by way of the originals only."""
    monkeypatch.setattr(minhash_dedup, "COMPARED", compared)
    rng, shared, texts = random.Random(7), words(100, 1), []
    for family in (0, 1):
        base = shared + words(120, 10 + family)
        for k in range(420 - 60 * family):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9, 14])):
                w[rng.randrange(len(w))] = f"new{family}{k}"
            texts.append((1000 * family + k, " ".join(w)))
    rng.shuffle(texts)
    components, _ = brute_components(texts)
    assert len(set(components.values())) > 20
    got = {r.doc_id: r.component_id for r in minhash_dedup.op6(spark, documents(spark, texts)).collect()}
    assert got == components


def test_near_duplicates_from_another_percent(spark):
    shingles, texts = (88, 84, 82, 80, 79), []  # of the shorter text of each pair; the longer has 100
    for k, n in enumerate(shingles):
        base = words(104, 50 + k)
        texts += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(base[: n + 4]))]
    for percent in (80, 85):
        found = minhash_dedup.near_duplicates(spark, documents(spark, texts), percent=percent).collect()
        assert {r.doc_id for r in found if not r.kept} == {10 * k + 1 for k, n in enumerate(shingles) if n >= percent}


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(200, 100)], "a long, b long"))
    found = {r.node: r.component for r in minhash_dedup.components(edges, Scratch(spark, "test")).collect()}
    assert all(found[i] == 0 for i in range(1, 61)) and found[200] == 100


def test_estimate_is_exact_for_small_sets(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4])], "a array<long>, b array<long>")
    assert df.select(minhash_dedup.estimate(F.col("a"), F.col("b")).alias("e")).first().e == 0.5


# --- 1: decontamination -----------------------------------------------------------------------------------------------

ITEMS = [
    (1, "In the year 1994 the baker Tom Harris sold 35 kg of flour to Anna for 12 dollars each day and kept 35 loaves."),
    (2, "Tiny five word item here."),
    (3, "A plain passage about rivers that bend slowly through the wide and quiet valley below the hills."),
    (None, "nothing has no id"),
    (4, None),
    (5, ""),
]


def test_leaks(spark):
    changed = "In the year 2004 the baker Jim Brown sold 48 kg of flour to Maria for 99 dollars each day and kept {} loaves."
    texts = [
        *EDGES,
        (10, f"Start. {ITEMS[0][1]} End."),
        (11, f"Before. {changed.format(48)} After."),
        (12, f"Before. {changed.format(49)} After."),
        (13, "TINY FIVE WORD ITEM HERE"),
        (14, "a plain passage about rivers that bend; other words follow here and nothing more is shared at all"),
        (15, "word " * 50 + ITEMS[2][1].upper() + " word" * 50),
        (15, "word " * 50 + ITEMS[2][1].upper() + " word" * 50),
    ]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, texts)
    got = {(r.doc_id, r.item_id): r.reparameterised for r in decontamination.op1(spark, docs, bench).collect()}
    assert got == {(10, 1): False, (11, 1): True, (13, 2): False, (15, 3): False}
    assert decontamination.op1(spark, docs, bench.limit(0)).collect() == []
    assert decontamination.op1(spark, docs.limit(0), bench).collect() == []


def test_leaks_without_the_prefilter(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PREFILTER", 0)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, [(1, f"x. {ITEMS[2][1]} y"), (2, "clean " * 40)])
    assert [(r.doc_id, r.item_id) for r in decontamination.op1(spark, docs, bench).collect()] == [(1, 3)]


def test_two_values_of_an_item_may_fall_on_one(spark):
    bench = spark.createDataFrame([(1, "The farmer put 3 apples and 5 pears into the basket before he went to the market.")], "item_id long, text string")
    told = "The farmer put {} apples and {} pears into the basket before he went to the market."
    docs = documents(spark, [(1, told.format(4, 4)), (2, told.format(3, 5)), (3, "clean " * 40)])
    assert {(r.doc_id, r.reparameterised) for r in decontamination.op1(spark, docs, bench).collect()} == {(1, True), (2, False)}


def test_short_and_number_heavy_items_match_whole(spark):
    items = ["yes no", "1 2 3 4 5 6 7 8 9 10", "12 + 30 = 42 and 5 * 6 = 30", "Unobtainium", "What is 17 times 23?", "7", ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [(10 + i, f"Here stands: {t} among others") for i, t in enumerate(items)]
    texts += [(30, "2 3 4 5 6 7 9 8 10 11"), (31, "no yes"), (32, "What is 18 times 23?"), (33, "12 + 31 = 43 and 5 * 6 = 30")]
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in decontamination.op1(spark, documents(spark, texts), bench).collect()}
    assert got == {(10 + i, i, False) for i in range(5)} | {(i, 5, False) for i in (11, 15, 30)}


def brute_template(text):
    """[(token, value or None)] of an ASCII text, by regular expressions."""
    out, last = [], None
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[A-Za-z]+", text):
        word, ahead = m[0].lower(), text[: m.start()]
        ink = ahead.rstrip(" \t\r\n\v\f")
        inside = ink and re.match(r"[A-Za-z0-9',]", ink[-1]) and "\n" not in ahead[len(ink) :]
        kind = "lit"
        if word[0].isdigit():
            kind = "num"
        elif last == "num" and word in decontamination.UNITS:
            kind = "unit"
        elif inside and re.match(r"[A-Z][a-z]", m[0]):
            kind = "name"
        if kind == "name" and last == "name":
            out[-1] = ("name", (*out[-1][1], word))
        else:
            out.append((word, None) if kind == "lit" else (kind, (word,)))
        last = kind
    return out


def brute_leaks(texts, items):
    def windows(tokens, size, exact):
        for i in range(len(tokens) - size + 1):
            own = tokens[i : i + size]
            poor = sum(v is None for _, v in own) < min(4, size)
            if poor == exact:
                yield i, tuple(own) if exact else tuple(t for t, _ in own), [v for _, v in own]

    found = set()
    for item_id, item in items:
        tokens = brute_template(item)
        size = min(8, len(tokens))
        exact = size > 0 and not any(True for _ in windows(tokens, size, False))
        own = list(windows(tokens, size, exact)) if size else []
        for doc_id, text in texts:
            diagonals = collections.defaultdict(list)
            for p, key, values in windows(brute_template(text or ""), size, exact) if own else ():
                for i, k, mine in own:
                    if k == key:
                        diagonals[p - i].append((i, {(a, b) for a, b in zip(mine, values, strict=True) if a is not None}))
            good = {}
            for d, hits in diagonals.items():
                bound = set().union(*(b for _, b in hits))
                if len({a for a, _ in bound}) == len(bound):
                    good[d] = ({i for i, _ in hits}, any(a != b for a, b in bound))
            covered = set().union(*(p for p, _ in good.values()))
            if good and len(covered) >= 0.5 * len({i for i, _, _ in own}):
                found.add((doc_id, item_id, all(c for _, c in good.values())))
    return found


def test_leaks_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = "the baker sold bread in a small town while rain fell on every old roof and people went home".split()

    def word():
        kind = rng.random()
        if kind < 0.15:
            return rng.choice(["3", "17", "2.5", "1,000", "40"]) + rng.choice([" kg", " days", "", ""])
        return rng.choice(["Anna", "Tom Harris", "Oslo"]) if kind < 0.3 else rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."])

    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 4, 7, 9, 14, 25])))) for i in range(40)]
    items += [(90, "4 5 6 7 8 9 1 2 3"), (91, "3 kg 17 days 40 kg 3 days 2.5"), (92, "he")]
    texts = []
    for k in range(120):
        item = rng.choice(items)[1]
        if k % 3 == 0:  # other values, each in place of one
            for a, b in (("Anna", "Maria"), ("Tom Harris", "Jim"), ("17", "99"), ("40", rng.choice(["41", "99"])), ("kg", "miles")):
                item = re.sub(rf"\b{a}\b", b, item)
        if k % 3 == 1:  # a part, or with a slip
            ws = item.split()
            ws[rng.randrange(len(ws))] = rng.choice(["Maria", "77", "else"])
            item = " ".join(ws[: rng.randrange(1, len(ws) + 1)])
        texts.append((k, " ".join(word() for _ in range(rng.randrange(12))) + f" {item} " + " ".join(word() for _ in range(rng.randrange(12)))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in decontamination.op1(spark, documents(spark, texts), bench).collect()}
    want = brute_leaks(texts, items)
    assert got == want and len(want) > 60 and any(c for *_, c in want)


# --- 2: personal data -------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_pii(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x[-4:]) > 255 or len(x.lstrip("0")) > 3 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


PERSONAL = [
    "a@b.c_d@e.f x@y.z. 1.2.3.4.5 999.1.1.1 0001.2.3.4 é😀 a@b.co +1 (555) 123-4567 +1 4111 1111 1111 1111 z@",
    "a." * 3000 + "@b" + ".c" * 3000, "x@" + "b." * 3000, "1" * 20000 + ".1.1.1", "1.2.3.4 " * 800, "+1((((" * 800, "4111111111111111" * 3, "4111-1111-1111-1111 12345678901234567",
]


def test_pii_against_brute_force(spark):
    rng = random.Random(1)
    fuzz = ["".join(rng.choice("a1@.+-_ ()5é") for _ in range(80)) for _ in range(150)]
    texts = [*EDGES, *enumerate(PERSONAL + fuzz, 100)]
    want = sorted(repr((i, hashlib.sha256(",".join(brute_pii(t)).encode()).hexdigest())) for i, t in texts)
    got = pii.op2(documents(spark, texts)).collect()
    assert sorted(repr((r.doc_id, r.base_sha256)) for r in got) == want
    one = next(r for r in got if r.doc_id == 100)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (4, 2, 0, 1)
    assert pii.op2(documents(spark, [])).collect() == []


def test_pii_validators_context_and_masks(spark):
    text = 'DE89 3704 0044 0532 0130 00 and DE00 3704 0044 0532 0130 00, ssn: 123-45-6789; order 123-45-6789 token = "abcdef0123456789abcdef0123" 7536784127813050 4845168114407329'
    df = documents(spark, [(1, text), (2, None), (3, "clean text 1.2.3")])
    found = pii.detected(df, into="found")
    assert found.columns == [*df.columns, "found"]
    rows = {r.doc_id: r.m for r in found.select("doc_id", pii.masked(F.coalesce("text", F.lit("")), F.col("found")["all"]).alias("m")).collect()}
    assert rows[1] == '<IBAN> and DE00 3704 0044 0532 0130 00, ssn: <SSN>; order 123-45-6789 token = "<SECRET>" <CARD> <CARD>'
    assert rows[2] == "" and rows[3] == "clean text 1.2.3"


def test_pii_in_long_texts(spark):
    """A text of a megabyte with 300,000 numbers, and long ones full of spans: minutes, if time grew with the square."""
    rng = random.Random(4)
    texts = [
        (1, " ".join(str(rng.randrange(100, 999)) for _ in range(300_000))), (2, "x 10.0.0.1 é, " * 40_000),
        (3, "a@b.c +1 555 123 4567 " * 20_000), (4, "4111111111111111 and 4845168114407329;" * 15_000), (5, "é" * 3_000_000 + " a@b.c " + "😀" * 5000),
    ]
    began = time.time()
    spans = F.col("found")["all"]
    found = pii.detected(documents(spark, texts), into="found").select("doc_id", pii.digest(F.col("found.base")).alias("d"), pii.masked(F.col("text"), spans).alias("m"))
    got = {r.doc_id: r for r in found.collect()}
    assert time.time() - began < 120
    for i, t in texts:
        assert got[i].d == ",".join(brute_pii(t))
    assert got[1].m == texts[0][1] and got[2].m == "x <IP> é, " * 40_000 and got[3].m == "<EMAIL> <PHONE> " * 20_000
    assert got[4].m == "<CARD> and <CARD>;" * 15_000 and got[5].m == texts[4][1].replace("a@b.c", "<EMAIL>")


def test_overlapping_spans_are_masked_together(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("aé😀 .") for _ in range(rng.choice([5, 1023, 1024, 1025, 5000])))
        starts = sorted(rng.randrange(len(text)) for _ in range(rng.choice([1, 3, 300])))
        rows.append((i, text, [(a, 0, "ip", min(len(text), a + rng.randrange(1, 40))) for a in starts]))
    df = spark.createDataFrame(rows, f"id int, text string, found {pii._SPANS}")
    got = {r.id: r.m for r in df.select("id", pii.masked(F.col("text"), F.col("found")).alias("m")).collect()}
    for i, text, found in rows:
        out, at = "", 0
        for a, _, _, b in found:
            out += text[at:a] + "<IP>" if a >= at else ""
            at = max(at, b)
        assert got[i] == out + text[at:]


def test_native_plans(spark):
    for df in (pii.op2(documents(spark, EDGES)), preference_format.op10(conversations(spark, [(0, 0, "user", "a")]))):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


# --- 4: url filter ----------------------------------------------------------------------------------------------------


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.COM/en/7?x", "http://a.example.com/en/6", "http://x.net/de/1", "http://b.example.net/de/81#f", "http://y.org/es/", "http://notexample.com/fr/", "http://www.spam-farm.example.org/x", "http://spam-farm.example.org.evil.com/fr/x", "a\nb://h/p\nq?r"]
    pages = spark.createDataFrame([(i, u, "rule?") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rows = {r.page_id: tuple(r)[1:] for r in url_filter.op4(spark, pages).collect()}
    assert rows[0] == rows[1] == rows[2] == ("", "", None, "allow")
    assert rows[3] == ("a.example.com", "/en/7", "example.com/en/7", "allow") and rows[4][2:] == ("com/en/", "block")
    assert rows[5][2:] == ("net/de/", "allow") and rows[6][2:] == ("example.net/de/8", "block") and rows[7][2:] == ("org/es/", "block")
    assert rows[8][2:] == (None, "allow") and rows[9][2:] == (None, "block") and rows[10][2:] == (None, "allow") and rows[11][:2] == ("h", "/p\nq")
    assert url_filter.op4(spark, pages.limit(0)).collect() == []


def test_known_spam(spark):
    """Names, mirrors and servers once each; what stands below a listed host is blocked, what only looks alike is not."""
    keys = [r.key for r in url_filter.known_spam(spark).collect()]
    assert len(keys) == len(set(keys)) == 3 * (len(url_filter.LURES) * len(url_filter.OFFERS) + len(url_filter.NAMES) * url_filter.MIRRORS + len(url_filter.SERVERS))
    blocked = ["vip-poker.example.com", "m.replica-watches.example.net", "a.b.ads.example.org", "free-bets1000.example.com", "spam-farm.example.net", "X.Ads-Track.EXAMPLE.com"]
    allowed = ["poker.example.com", "vip-poker.example", "ads.example.com.evil.net", "myads.example.org", "free-bets1001.example.com", "vip-poker1.example.com", "example.com"]
    pages = spark.createDataFrame([(i, f"http://{h}/fr/") for i, h in enumerate(blocked + allowed)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.op4(spark, pages).collect()}
    assert got == {i: "block" if i < len(blocked) else "allow" for i in range(len(blocked + allowed))}


@pytest.mark.parametrize("listed", [0, 1, 40, 2900])
def test_cascade_is_exact(spark, listed):
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    chosen = universe.where(f"cast(substring(key, 2) as int) < {listed}")
    levels = url_filter.build(chosen.unionByName(spark.createDataFrame([("absent",)], "key string")), universe, Scratch(spark, "test"))
    found = universe.where(url_filter.member(F.col("key"), levels)) if levels else universe.limit(0)
    assert sorted(r.key for r in found.collect()) == sorted(r.key for r in chosen.collect())


def test_columns_of_a_level(spark):
    """The bits are those that the keys' positions name, and only one value of them comes to the driver."""
    keys = spark.range(300).selectExpr("concat('k', id) as key")
    level = url_filter.Level(0, 5000, 3)
    level.fill(keys)
    at = {r.at for r in keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at")).collect()}
    assert len(level.bits) * 8 == level.size >= 5000
    assert at == {i for i in range(level.size) if level.bits[i // 32 * 4 + 3 - i % 32 // 8] >> i % 8 & 1}


def test_urls_keep_other_columns(spark):
    pages = spark.createDataFrame([(1, "http://www.spam-farm7.example.org/x", "a", "b"), (2, None, None, None)], "page_id long, url string, _rule string, _listed string")
    out = url_filter.filtered(spark, pages, url_filter.known_spam(spark))
    assert out.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert {(r.page_id, r._rule, r._listed, r.verdict) for r in out.collect()} == {(1, "a", "b", "block"), (2, None, None, "allow")}


def test_long_list_is_joined(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "LARGEST", 1)
    pages = spark.createDataFrame([(1, "http://www.spam-farm.example.org/x"), (2, "http://ok.com/x"), (3, None)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.op4(spark, pages).collect()} == {1: "block", 2: "allow", 3: "allow"}


# --- 5: warc ----------------------------------------------------------------------------------------------------------


def brute_warc(rows):
    """Rows of op 5's query for pages (page_id, url, html)."""
    payload = lambda h: (h or "").encode()
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[payload(h)] = min(i, least.get(payload(h), i))
    out = collections.Counter()
    for i, _, h in rows:
        again = i is not None and i > least[payload(h)]
        digest = base64.b32encode(hashlib.sha1(payload(h)).digest()).decode()
        out[(i, len(payload(h)), digest, "revisit" if again else "response", least[payload(h)] if again else None, None)] += 1
    return out


def test_warc_round_trip(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * 400) for i in range(120)] + [(200, None, None), (201, "http://a/\r\nX: y", ""), (203, "u", "dup"), (202, "ü v", "dup"), (None, "u", "dup"), (202, "u", "dup")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, first string")
    assert collections.Counter(map(tuple, warc.op5(spark, pages).collect())) == brute_warc(rows)
    assert warc.op5(spark, pages.limit(0)).collect() == []


def test_warc_query_against_brute_force(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    got = collections.Counter(map(tuple, queries.QUERIES["op5_warc"](spark, folder).collect()))
    assert got == brute_warc([tuple(r) for r in pages.collect()]) and len(got) > 1


def test_warc_files_and_faults(spark, tmp_path):
    records = [warc.record(i, f"http://h/{i}", f"body {i} ".encode() * 900, None) for i in range(60)]
    data = warc.archive(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.frames(data)) == records
    assert list(warc.frames(warc.archive(records[:2]))) == records[:2]
    (tmp_path / "a.warc.zst").write_bytes(data)
    (tmp_path / "b.warc.zst").write_bytes(data[:-7])
    found = warc.read(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert sum(r.error is None for r in found) == 119 and [r.error for r in found if r.error] == ["the last frame is cut off"]
    assert warc.parse(records[1].replace(b"body 1", b"body 2", 1))["error"] == "block digest differs"
    assert warc.parse(records[1][:-1])["error"] == "Content-Length and block differ"
    assert warc.parse(b"GIF89a")["error"] == "no WARC header"
    assert warc.parse(records[1].replace(b"WARC-Date", b"WARC-Data"))["error"] == "no warc-date"


# --- 7: html ----------------------------------------------------------------------------------------------------------


def test_html_structure():
    page = """<html><head><title>t</title></head><body><nav><ul><li>menu</li></ul></nav><div class="ad">buy</div><article><header><h1>Title &amp; more</h1></header>
    <p>one <b>two<br>three</p><p>four<p>five<ul><li>six<li>seven</ul><script>var a = "</p>";</script><div class="side-bar">no</div></article>
    <section id="comments"><p>no</p></section><footer>no</footer>"""
    assert html_extract.main_text(page) == "Title & more\n\none two three\n\nfour\n\nfive\n\nsix\n\nseven"
    assert html_extract.main_text("<p>no article</p><form>x</form>1 < 2") == "no article\n\n1 < 2"
    for odd in (None, "", "<", "<!-- open", "<script>open", "<p", "</p></p>", '<a href="x', "<" * 20000, "<p>" * 20000, "<div><b>" * 3000):
        assert isinstance(html_extract.main_text(odd), str)


def test_templates_are_what_pages_share(spark):
    def page(i):
        return f"<body><p>Welcome to the site</p><div><p>{' '.join(words(40, i))}</p></div><p>All rights reserved</p></body>"

    rows = [(i, "http://h/x", page(i), "own") for i in range(6)] + [(10, "http://h/y", page(0), "own"), (11, None, None, "own"), (12, "http://other/", page(7), "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = html_extract.extracted(spark, pages)
    assert out.columns == [*pages.columns, "text"] and {r.host for r in out.collect()} == {"own"}
    text = {r.page_id: r.text for r in out.collect()}
    assert text[1] == " ".join(words(40, 1)) and text[10] == text[0] and text[11] == ""
    assert text[12].startswith("Welcome to the site\n\n")
    assert html_extract.op7(spark, pages.limit(0)).collect() == []

    # copies of any one page take no other page's place in the sample
    rows = [(i, f"http://h{h}/x{i}", page(i)) for h in range(6) for i in [*range(6), *[h] * 20]]
    again = html_extract.extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {(r.page_id, r.text) for r in again.collect()} == {(i, " ".join(words(40, i))) for i in range(6)}


def test_templates_are_judged_on_all_pages(spark):
    def page(i, layout, licence):
        text = f"<p>{' '.join(words(40, i))}</p>" + "<p>Free to copy under licence</p>" * licence
        if layout == 0:
            return f"<body><p>Welcome to the site</p><div>{text}</div></body>"
        return f"<body><section><p>Wiki of the site</p></section><section>{text}</section></body>"

    # host a: a paragraph of most pages stays; b: two layouts each lose their own head; c: as a, in another layout too
    rows = [(i, "http://a/", page(i, 0, i % 10 > 0)) for i in range(60)]
    rows += [(100 + i, "http://b/", page(i, i % 2, False)) for i in range(40)]
    rows += [(200 + i, "http://c/", page(i, i % 2, i % 20 > 1)) for i in range(60)]
    out = html_extract.extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    licence = lambda i: "\n\nFree to copy under licence" * (i % 10 > 0 if i < 100 else i >= 200 and i % 20 > 1)
    assert {r.page_id: r.text for r in out.collect()} == {i: " ".join(words(40, i % 100)) + licence(i) for i, _, _ in rows}


def nameless(html):
    """A page whose tags and classes tell nothing about its parts."""
    return re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(?:article|nav|footer|header|section|aside|main)\b[^>]*>", r"<\1div>", html or ""))


def test_wrapper_without_telling_names(spark):
    def page(i):
        menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(6, i))
        notice = f"<div>{' '.join(words(5, 200 + i))}</div>" * (i % 3 > 0)  # varies, and not on all pages
        text = f"<h2>{' '.join(words(3, 300 + i))}</h2>" + "".join(f"<p>{' '.join(words(25, 400 + 10 * i + k))}</p>" for k in range(3 + i % 2))
        also = "<ul><li><a href='/a'>Read the first of these</a></li></ul>"
        return f"<body><div>Welcome to the site</div><div><ul>{menu}</ul></div>{notice}<div>{text}{also}</div><div>{' '.join(words(4, 600 + i))}</div></body>"

    want = {i: "\n\n".join([" ".join(words(3, 300 + i)), *(" ".join(words(25, 400 + 10 * i + k)) for k in range(3 + i % 2))]) for i in range(24)}
    rows = [(i, "http://h/", page(i)) for i in range(24)] + [(100, "http://one.page/", page(0))]
    got = {r.page_id: r.text for r in html_extract.extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: got[i] for i in want} == want
    assert got[100].startswith("Welcome to the site")  # one page shows no slots


def test_wrapper_finds_what_names_tell(spark, folder):
    """On the test pages the content found without any telling name is the one that their markup names."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    rows = [(r.page_id, "http://h/", nameless(r.html)) for r in pages]
    got = {r.page_id: r.text for r in html_extract.extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    named = {r.page_id: html_extract.main_text(r.html) for r in pages}
    bare = {i: html_extract.main_text(h) for i, _, h in rows}
    assert sum(got[i] == named[i] for i in named) >= 0.9 * len(named) and not any(bare[i] == named[i] for i in named)


def brute_match(a, b):
    """The largest mapping of two trees with equal roots, by trying every choice of child pairs in order."""
    if a.tag != b.tag:
        return 0
    own = 1 + sum(x.text == y.text for x, y in zip(a.blocks, b.blocks, strict=False))
    n, m, most = len(a.children), len(b.children), 0
    for k in range(min(n, m) + 1):
        for left in itertools.combinations(range(n), k):
            for right in itertools.combinations(range(m), k):
                most = max(most, sum(brute_match(a.children[i], b.children[j]) for i, j in zip(left, right, strict=True)))
    return own + most


def test_tree_matching_against_brute_force():
    rng = random.Random(8)

    def grow(depth):
        node = html_extract.Node(rng.choice("xy"))
        node.blocks = [html_extract.Block(rng.choice("pq"), False, None, False, False)] if rng.random() < 0.6 else []
        node.children = [grow(depth - 1) for _ in range(rng.randrange(4))] if depth else []
        return node

    for _ in range(300):
        a, b = grow(2), grow(2)
        b.tag = a.tag
        size, pairs = html_extract.match(a, b)
        assert size == brute_match(a, b) == html_extract.match(b, a)[0]
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert size == len(pairs) + sum(x.text == y.text for x, y in html_extract.slots(pairs))


# --- 8: packing -------------------------------------------------------------------------------------------------------


def test_packing_against_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rng, signs = random.Random(3), "aAéÉ×÷ß'.,;1 \n\t😀İΣœñ½-“́\xa0"
    odd = ["a\x1cb !!\x1c! x", "don't 12,5 <|endoftext|>x <|ENDOFTEXT|>", "日本 한국 a‍b", *("".join(rng.choice(signs) for _ in range(25)) for _ in range(300))]
    texts = [*EDGES, (50, " ".join(words(9000, 1))), *enumerate(odd, 1000)]
    rows = packing.op8(documents(spark, texts).repartition(3)).collect()
    ids = {i: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in texts}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, own in pieces.items():
        times = sum(j == i for j, _ in texts)
        assert sum(r.length for r in own) == times * len(ids[i])
        for r in own:
            assert r.doc_tokens == len(ids[i]) and r.ids_crc32 == zlib.crc32(ids[i][r.start : r.start + r.length].tobytes())
        if times == 1:
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at
                at += r.length
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0
    assert set(pieces) == set(ids) and packing.op8(documents(spark, [])).collect() == []


def test_packing_balances_cost():
    rng = random.Random(0)
    lengths = [rng.randrange(50, 1500) for _ in range(400)]
    load, full = collections.Counter(), collections.Counter()
    for _, _, n, s, _ in packing.pack(lengths):
        load[s] += packing.cost(n)
        full[s] += n
    whole = [load[s] for s, n in full.items() if n == 4096]
    assert max(whole) < 1.2 * min(whole) and sum(full.values()) == sum(lengths)


# --- 9: repeats -------------------------------------------------------------------------------------------------------


def brute_repeats(texts, window):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - window + 1):
            if count[d[i : i + window]] > 1:
                hit[i : i + window] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~hit])
        out.append((len(d), int(hit.sum()), int(np.diff(np.concatenate([[0], hit.astype(int)])).clip(0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def brute_passages(texts, n):
    """Words of each text inside n words in a row that stand twice or more in all the texts together."""
    split = [re.findall(r"[^ \t-\r]+", t or "") for t in texts]
    count = collections.Counter(tuple(ws[i : i + n]) for ws in split for i in range(len(ws) - n + 1))
    return [len({j for i in range(len(ws) - n + 1) if count[tuple(ws[i : i + n])] > 1 for j in range(i, i + n)}) for ws in split]


@pytest.mark.parametrize(("large", "slab"), [(20_000, 1 << 22), (2, 1 << 22), (20_000, 100)])
def test_repeats_against_brute_force(spark, large, slab, monkeypatch):
    passage = " ".join(words(60, 5))
    texts = [None, "", "ab" * 300, "é" * 90 + "q" + "é" * 90, "x" * 2000, passage, *(" ".join(words(20, i)) + passage[: 80 + 20 * i] + " ".join(words(15, 50 + i)) for i in range(12))]
    texts += [texts[-1], texts[-1].replace("a", "b", 1), "so it goes and " * 9, *(f"start{i}  " + " \t".join("abcdefghijk") + f"\nend{i}" for i in range(3))]
    ids = [*range(len(texts) - 1), None]
    docs = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, start int")
    if slab < 1000:  # single texts, so that the slabs' workers see the size too
        for data in (t.encode() for t in texts if t and len(t) > 60):
            monkeypatch.setattr(repeat_spans, "SLAB", slab)
            values = rolling.BYTE[np.frombuffer(data, np.uint8)]
            starts = []
            for at, piece, own in repeat_spans._slabs(values, np.array([0, len(values)]), 60):
                _, first, last, _ = repeat_spans.anchors(len(piece), own, repeat_spans.Hashes(piece), 60, 16)
                starts += [at + x for f, z in zip(first, last, strict=True) for x in range(f, z + 1)]
            assert starts == list(range(len(data) - 59))
        return
    got = repeat_spans.without_repeats(spark, docs, window=60, gram=16, passage=9, passage_gram=3, large=large).collect()
    want = zip(ids, brute_repeats(texts, 60), brute_passages(texts, 9), strict=True)
    assert sorted(repr((i, *b, n)) for i, b, n in want) == sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_words)) for r in got)
    assert any(r.n_passage_words and not r.n_removed for r in got)
    assert repeat_spans.op9(spark, docs.limit(0)).collect() == []


def test_columns_find_common_windows():
    rng = random.Random(2)
    for _ in range(30):
        m, back = rng.randrange(2, 12), rng.randrange(0, 6)
        backs = [rng.randrange(0, back + 1) for _ in range(m)]
        contents = [bytes(rng.choice(b"ab") for _ in range(b + rng.randrange(1, 12))) for b in backs]
        found = repeat_spans.sorted_columns(repeat_spans.symbols_of(contents, False), np.array(backs), 5)
        for i, (x, b) in enumerate(zip(contents, backs, strict=True)):
            for j in range(found.shape[1]):
                mine = x[b - j : b - j + 5] if b >= j else b""
                others = (y[c - j : c - j + 5] for k, (y, c) in enumerate(zip(contents, backs, strict=True)) if k != i and c >= j)
                assert found[i, j] == (len(mine) == 5 and any(mine == y for y in others))


# --- 10: preference pairs ---------------------------------------------------------------------------------------------


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")


def test_preference_pairs(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "more"), (0, 3, "assistant", "good <|end|>"),
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"), (1, 4, None, None), (1, 5, "assistant", "so"),
        (2, 0, "user", "alone"), (4, 0, "user", "a"), (4, 0, "user", "a"), (5, 0, "user", "a"), (None, 0, "user", "x"), (6, None, "user", "x"), (7, 0, "user", "x"),
    ]
    pairs = spark.createDataFrame([(i, 2 * i, 2 * i + 1) for i in range(4)], "pair_id long, chosen_id long, rejected_id long")
    for block in (256, 2):
        out = preference_format.paired(conversations(spark, rows), pairs, block).orderBy("block").collect()
        assert {r.pair_id for r in out} == {0, 2} and len(out) == (2 if block == 256 else 4)
        whole = {k: "".join(r[k] for r in out if r.pair_id == 0) for k in ("prompt", "chosen", "rejected")}
        assert whole["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nmore<|end|>\n"
        assert whole["chosen"] == "<|assistant|>\ngood < |end|><|end|>\n"
        assert whole["rejected"] == "<|assistant|>\nbad<|end|>\n<||>\n<|end|>\n<|assistant|>\nso<|end|>\n"
        trained = lambda k: [r[k][slice(*map(int, x.split(":")))] for r in out if r.pair_id == 0 for x in r[f"{k}_spans"].split(",") if x]  # noqa: B023, E731
        assert trained("chosen") == ["good < |end|><|end|>"] and trained("rejected") == ["bad<|end|>", "so<|end|>"]
        same = next(r for r in out if r.pair_id == 2)
        assert (same.prompt, same.chosen, same.rejected, same.chosen_spans, same.prompt_turns) == ("<|user|>\na<|end|>\n", "", "", "", 1)


def test_broken_off_replies_are_rejected(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "é😀 four"), (1, 2, "user", "left out"), (2, 0, "user", "no reply"),
        (3, 5, "assistant", ""), (4, 0, None, None), (4, 1, "assistant", "yes"), (4, 1, "assistant", "yes"), (None, 0, "assistant", "x"), (5, None, "assistant", "x"),
        *((6, i, "user" if i % 2 else "assistant", "again") for i in range(601)),
    ]
    out = {(r.pair_id, r.block): r for r in preference_format.op10(conversations(spark, rows)).collect()}
    assert set(out) == {(1, 0), (3, 0), (4, 0), (6, 0), (6, 1), (6, 2)}
    r = out[1, 0]
    assert (r.prompt, r.chosen, r.rejected) == ("<|user|>\nhi<|end|>\n", "<|assistant|>\né😀 four<|end|>\n", "<|assistant|>\né😀 <|end|>\n")
    assert (r.chosen_spans, r.rejected_spans, r.prompt_turns, r.chosen_turns) == ("14:28", "14:24", 1, 1)
    assert out[3, 0].chosen == "" and out[3, 0].prompt_turns == 1  # an empty reply can't be broken off
    assert out[4, 0].prompt == "<||>\n<|end|>\n" and out[4, 0].rejected == "<|assistant|>\ny<|end|>\n"
    assert [out[6, b].prompt_turns for b in range(3)] == [256, 256, 88] and out[6, 2].chosen_turns == 1
    assert preference_format.op10(conversations(spark, [])).collect() == []


# --- shared -----------------------------------------------------------------------------------------------------------


def test_hashes_do_not_depend_on_batches():
    texts = ["alpha beta gamma", None, "", "beta alpha", "x" * 5000, "é ü"]
    def all_hashes(size):
        out = []
        for data, offsets in rolling.chunks(pa.array(texts), size):
            start, end, _ = rolling.words(data, offsets)
            out += rolling.hash_spans(data, start, end).tolist()
        return out

    assert all_hashes(1) == all_hashes(1 << 20) and len(set(all_hashes(1))) == 6
    assert list(rolling.chunks(pa.array([], pa.string()))) == []
