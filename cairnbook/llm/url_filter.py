"""URL filtering with a Bloom filter cascade, in SQL expressions.

Level 0 encodes the listed keys. Of the corpus's complete key universe, the unlisted keys that pass it (its false
positives) are encoded in level 1; the listed keys that pass level 1 in level 2; and so on, until a level has no false
positives. A key's first level that it does not pass then tells membership exactly, for every key of the universe,
without a join.

A level's bits are set on the executors, in words of 32 that an aggregation joins; what the driver gets of a level is one
binary value of a bit for each bit, which goes into the plan once. Level 0 is sized so that it lets about as many false
positives through as there are listed keys, so all levels together are a few bytes a listed key, whatever the size of the
corpus. Lists of more than ``LARGEST`` keys (levels of about 10 MB) are joined by host instead, with the same result.

Keys are a host and its parent domains, so a listed domain blocks its subdomains. Rules (allow or block, by host and
path prefix) come first: the longest that fits decides. Null urls and urls without "://" have an empty host and path: no
rule fits, no key is listed, they are allowed. Repeated pages are judged each; an empty list or table gives no blocks.
Columns named host, path, rule or verdict are replaced; other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, free_name

#: (verdict, host, path)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Words that names of spam hosts are made of, and hosts that serve adverts, each under three domains.
LURES = (
    "ads", "adult", "bonus", "casino", "cheap", "crypto", "discount", "easy", "fake", "free", "hot", "instant", "lucky", "mega",
    "miracle", "pirate", "quick", "replica", "sexy", "slots", "spam", "super", "vip", "win",
)
OFFERS = (
    "bets", "bonus", "casino", "click", "coins", "deals", "diet", "farm", "girls", "jackpot", "links", "loans", "movies", "pills",
    "poker", "prizes", "slots", "streams", "track", "watches", "win", "x",
)
SERVERS = ("ads", "adserver", "banners", "click", "popup", "track")
#: Names that have numbered mirrors, and how many of them are listed too.
NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
MIRRORS = 1000
LARGEST = 4_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<size, rule, verdict> of the longest rule that fits, else null."""
    fitting = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*fitting)))


def keys_of(host: Column) -> Column:
    """The host and its parent domains; none for an empty host."""
    labels = F.split(host, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host != "", tails).otherwise(F.array().cast("array<string>"))


class Level:
    """One Bloom filter: ``k`` positions a key in ``size`` bits, in words of 32 bits, high bytes first."""

    def __init__(self, number: int, size: int, k: int):
        self.number, self.words, self.k, self.bits = number, -(-size // 32), k, b""
        self.size = 32 * self.words

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.number), F.lit(j), key), F.lit(self.size)) for j in range(self.k)]

    def fill(self, keys: DataFrame) -> None:
        """Sets the keys' bits: an aggregation of (word, bits), brought together as one value of size / 8 bytes."""
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("at"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 32).cast("int"))
        words = at.select(F.floor(F.col("at") / 32).alias("word"), one.alias("bits"))
        words = words.unionByName(keys.sparkSession.range(self.words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
        words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
        shown = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: F.lpad(F.hex(x["bits"]), 8, "0"))
        self.bits = bytes(words.agg(F.unhex(F.array_join(shown, "")).alias("bits")).first().bits)

    def passes(self, key: Column) -> Column:
        def all_set(bits: Column) -> Column:
            out = F.lit(True)
            for p in self.positions(key):
                byte = F.floor(p / 32) * 4 + 3 - F.floor(p % 32 / 8)
                value = F.ascii(F.decode(F.substr(bits, (byte + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
                out = out & (F.call_function("shiftright", value, (p % 8).cast("int")) % 2 == 1)
            return out

        return F.transform(F.array(F.lit(self.bits)), all_set)[0]


def build(listed: DataFrame, universe: DataFrame, scratch: Scratch) -> list[Level]:
    """The levels for listed keys (column ``key``) among the keys of ``universe``."""
    inside = scratch.keep(universe.join(listed, "key", "left_semi"), "listed")
    outside = universe.join(listed, "key", "left_anti")
    n, all_keys = inside.count(), universe.count()
    levels: list[Level] = []
    encode, test, rate = inside, outside, max(1e-9, min(0.5, n / max(1, all_keys - n)))
    while n:
        k = max(1, round(-math.log2(rate)))
        level = Level(len(levels), max(64, math.ceil(1.45 * k * n)), k)
        level.fill(encode)
        levels.append(level)
        wrong = scratch.keep(test.where(level.passes(F.col("key"))), f"wrong-{len(levels)}")
        encode, test, n, rate = wrong, encode, wrong.count(), 0.5
    return levels


def member(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: odd levels hold unlisted keys, even ones listed keys."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(level.passes(key), out).otherwise(level.number % 2 == 1)
    return out


def filtered(spark: SparkSession, pages: DataFrame, listed: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """pages with host, path, rule, verdict."""
    scratch = Scratch(spark, "urls")
    url = F.col(url_col)
    hosts = pages.select(host_of(url).alias("host")).distinct()
    universe = scratch.keep(hosts.select(F.explode(keys_of(F.col("host"))).alias("key")).distinct(), "universe")
    listed = listed.select("key").distinct()
    own, ruled = free_name(pages, "_listed"), free_name(pages, "_rule")
    out = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    if listed.count() <= LARGEST:
        levels = build(listed, universe, scratch)
        bad = F.exists(keys_of(F.col("host")), lambda key: member(key, levels)) if levels else F.lit(False)
    else:
        blocked = hosts.select("host", F.explode(keys_of(F.col("host"))).alias("key")).join(listed, "key", "left_semi")
        out = out.join(blocked.select("host", F.lit(True).alias(own)).distinct(), "host", "left")
        bad = F.coalesce(own, F.lit(False))
    out = out.withColumns({ruled: rule_of(F.col("host"), F.col("path"), rules), own: bad})
    verdict = F.coalesce(F.col(ruled)["verdict"], F.when(F.col(own), "block").otherwise("allow"))
    return out.withColumns({"rule": F.col(ruled)["rule"], "verdict": verdict}).drop(ruled, own)


def known_spam(spark: SparkSession) -> DataFrame:
    """The query's list (key), under three domains: every lure with every offer, ``NAMES`` with the numbers up to
    ``MIRRORS``, and ``SERVERS``, which are parents of whatever stands below them."""
    each = lambda values, name: F.explode(F.array(*map(F.lit, values))).alias(name)
    one = spark.range(1)
    names = one.select(each(LURES, "lure")).select("lure", each(OFFERS, "offer")).select(F.concat("lure", F.lit("-"), "offer").alias("name"))
    mirrors = spark.range(1, MIRRORS + 1).select("id", each(NAMES, "name")).select(F.concat("name", F.col("id").cast("string")).alias("name"))
    rows = names.unionByName(mirrors).unionByName(one.select(each(SERVERS, "name")))
    return rows.select("name", each(("com", "net", "org"), "top")).select(F.concat("name", F.lit(".example."), "top").alias("key"))


def op4(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return filtered(spark, pages.select("page_id", "url"), known_spam(spark)).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
                                ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
names AS (
  SELECT lure || '-' || offer AS n
  FROM unnest(['ads', 'adult', 'bonus', 'casino', 'cheap', 'crypto', 'discount', 'easy', 'fake', 'free', 'hot', 'instant', 'lucky',
               'mega', 'miracle', 'pirate', 'quick', 'replica', 'sexy', 'slots', 'spam', 'super', 'vip', 'win']) a(lure),
       unnest(['bets', 'bonus', 'casino', 'click', 'coins', 'deals', 'diet', 'farm', 'girls', 'jackpot', 'links', 'loans', 'movies',
               'pills', 'poker', 'prizes', 'slots', 'streams', 'track', 'watches', 'win', 'x']) b(offer)
  UNION ALL
  SELECT m || i FROM unnest(['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) c(m), range(1, 1001) d(i)
  UNION ALL
  SELECT unnest(['ads', 'adserver', 'banners', 'click', 'popup', 'track'])),
listed AS (SELECT n || '.example.' || t AS h FROM names, unnest(['com', 'net', 'org']) e(t)),
named AS (SELECT host, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS h
          FROM (SELECT DISTINCT host, string_split(host, '.') AS labels FROM parts)),
spam AS (SELECT DISTINCT host FROM named JOIN listed USING (h))
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN host IN (SELECT host FROM spam)
                                   THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT *, (SELECT max({'size': length(h || p), 'rule': h || p, 'verdict': verdict}) FROM rules
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parts)
"""
