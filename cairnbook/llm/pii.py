"""Personal data in texts, with SQL expressions only.

Regular expressions propose spans; validators confirm them (Luhn for cards, mod 97 for IBANs, value ranges for
addresses and numbers); for kinds whose form proves little, words nearby add to a score that must reach ``ACCEPT``.

The base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of fixed patterns; the expressions
used here match the same spans but never try a start inside a run again, so time stays linear in the text. Spans that
the method adds: iban, ssn, secret, and card numbers that stand among other digits.

Positions count code points, end exclusive. Null text counts as empty and has no spans; repeated rows are judged each on
its own; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
ACCEPT = 60
#: Code points before a span in which words count.
NEAR = 40
#: Values that are summed at once; sizes, in code points, in which long texts are cut up.
PIECE, CHUNKS = 128, (1 << 22, 1 << 16, 1 << 10)
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"

_LOCAL = "A-Za-z0-9._%+-"
#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VG",
    23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL",
    29: "BR PS QA UA", 30: "JO KW MU", 31: "MT",
}
_FIXED = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # of the country's length, so that words after it are not taken for a part of it; else as long as there is
    "iban": rf"(?<![A-Za-z0-9])(?:{_FIXED}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}+",
    "inner card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
}
#: What a text must hold for a pattern to be tried.
GATES = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]",
    "secret": r"[A-Za-z0-9_+/-]{24}",
    "inner card": r"[0-9](?:[\x20-]?[0-9]){13}",
}
#: Points for a word before the span, by kind.
WORDS = {
    "ssn": [(50, r"\b(?:ssn|social security|tax id|taxpayer)\b"), (-30, r"\b(?:order|invoice|part|isbn|version)\b")],
    "secret": [
        (50, r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|credential|bearer)[\"'\x20]*[:=]?[\"'\x20]*$"),
        (-60, r"(?:sha1|sha256|md5|commit|checksum|digest|https?:\S*)\W*$"),
    ],
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _mod97(iban: Column) -> Column:
    """Whether an IBAN's check digits hold: letters as 10 to 35, the first four characters last, remainder 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(so_far: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (so_far * 10 + code - 48) % 97).otherwise((so_far * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _score(kind: str, start: int, before: Column) -> Column:
    near = F.lower(F.right(before, F.lit(NEAR)))
    total = F.lit(start)
    for points, word in WORDS[kind]:
        total = total + F.when(near.rlike(word), points).otherwise(0)
    return total >= ACCEPT


def _valid(kind: str, x: Column, before: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    digits = F.regexp_replace(x, "[^0-9]", "")
    if kind == "ip":
        return x.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind in ("card", "inner card"):
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return _mod97(x)
    if kind == "ssn":
        return ~x.rlike("^(?:000|666|9..)|-00-|-0000$") & _score(kind, 40, before)
    if kind == "secret":
        mixed = x.rlike("[0-9]") & x.rlike("[A-Za-z]")
        return mixed & _score(kind, 30, before)
    return F.lit(True)


def _running(values: Column, step: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """What ``step`` gives, from 0 on, before each value of an int array and, last, after all: running sums or maxima.

    An array grows by copying, so values are taken in pieces of ``PIECE``, the pieces' totals likewise, and so on: time
    stays in proportion to the array.
    """

    def within(piece: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array(first).alias("out"))

        def more(s: Column, x: Column) -> Column:
            return _let(step(s["at"], x), lambda at: F.struct(at.alias("at"), F.concat(s["out"], F.array(at)).alias("out")))

        return F.aggregate(piece, state, more, lambda s: s["out"])

    def split(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PIECE).cast("int"))
        pieces = F.transform(starts, lambda i: F.slice(v, i * PIECE + 1, F.lit(PIECE)))
        totals = F.transform(pieces, lambda piece: F.aggregate(piece, F.lit(0), step))
        ahead = F.zip_with(pieces, _running(totals, step, levels - 1), lambda piece, first: F.slice(within(piece, first), 1, F.size(piece)))
        return F.concat(F.flatten(F.filter(ahead, lambda x: x.isNotNull())), F.array(F.aggregate(v, F.lit(0), step)))

    if levels == 1:
        return within(values, F.lit(0))
    return _let(values, lambda v: F.when(F.size(v) <= PIECE, within(v, F.lit(0))).otherwise(split(v)))


def _spans(text: Column, pattern: str) -> Column:
    """The confirmed spans of one pattern, in order."""
    kind = pattern.split()[-1]
    rank = F.lit(KINDS.index(kind))
    none = F.array().cast(_SPANS)
    hits = F.regexp_extract_all(text, F.lit(PATTERNS[pattern]), F.lit(0))
    gaps = F.split(text, PATTERNS[pattern], -1)

    def located(both: Column) -> Column:
        """A hit starts after the gaps and hits before it and its own gap."""
        lengths = F.zip_with(both["gaps"], both["hits"], lambda gap, hit: F.length(gap) + F.coalesce(F.length(hit), F.lit(0)))
        return F.arrays_zip(both["gaps"], both["hits"], _running(lengths, lambda at, x: at + x).alias("before"))

    def confirmed(x: Column) -> Column:
        start = x["before"] + F.length(x["gaps"])
        span = F.struct(start.alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), (start + F.length(x["hits"])).alias("end"))
        return F.when(x["hits"].isNotNull() & _valid(pattern, x["hits"], x["gaps"]), span)

    gate = text.contains(GATES[pattern]) if len(GATES[pattern]) == 1 else text.rlike(GATES[pattern])
    return F.when(gate, F.array_compact(F.transform(_let(F.struct(hits.alias("hits"), gaps.alias("gaps")), located), confirmed))).otherwise(none)


def _new(found: Column, known: Column, kind: str) -> Column:
    """The spans of one kind that are not among the known ones; compared as whole numbers, which Spark hashes."""
    number = lambda spans: F.transform(spans, lambda x: F.shiftleft(x["start"].cast("long"), 31) + x["end"])
    same = F.filter(known, lambda x: x["kind"] == kind)
    start = lambda x: F.shiftright(x, 31).cast("int").alias("start")
    end = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("end")
    new = F.array_except(number(found), number(same))
    return F.transform(new, lambda x: F.struct(start(x), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end(x)))


def spans(text: Column) -> Column:
    """struct<base, all> of a text column; each an array<struct<start, rank, kind, end>> by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    base = F.array_sort(F.concat(*(_spans(text, p) for p in BASE)))
    added = [_spans(text, p) for p in PATTERNS if p not in BASE and p in KINDS]
    inner = _spans(text, "inner card")
    together = lambda b: F.struct(b.alias("base"), F.array_sort(F.concat(b, *added, _new(inner, b, "card"))).alias("all"))
    return _let(base, together)


def digest(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _chunks(text: Column, sizes: tuple[int, ...] = CHUNKS) -> Column:
    """The text in chunks of the last of ``sizes`` code points: a position in a long string is found by counting."""
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / sizes[0]).cast("int"))
    cut = F.transform(starts, lambda i: F.substr(text, i * sizes[0] + 1, F.lit(sizes[0])))
    return F.flatten(F.transform(cut, lambda x: _chunks(x, sizes[1:]))) if sizes[1:] else cut


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """The code points from start to end of a text in chunks."""
    size = CHUNKS[-1]
    number = lambda at: F.floor(at / size).cast("int")
    first, last = number(start), number(end - 1)
    within = F.substr(F.get(chunks, first), start % size + 1, end - start)
    over = F.concat(
        F.substr(F.get(chunks, first), start % size + 1), F.array_join(F.slice(chunks, first + 2, last - first - 1), ""),
        F.substr(F.get(chunks, last), F.lit(1), end - last * size),
    )
    return F.when(start >= end, "").when(first == last, within).otherwise(over)


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans go together."""

    def replaced(x: Column) -> Column:
        """before: the end of all spans before each."""
        before = _running(F.transform(x["found"], lambda s: s["end"]), lambda at, end: F.greatest(at, end))
        placed = F.zip_with(x["found"], F.slice(before, 1, F.size(x["found"])), lambda s, b: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), b.alias("before")))
        fresh = F.filter(placed, lambda s: s["start"] >= s["before"])
        parts = F.transform(fresh, lambda s: F.concat(_between(x["chunks"], s["before"], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        tail = _let(F.array_max(F.transform(x["found"], lambda s: s["end"])), lambda end: _between(x["chunks"], end, x["length"]))
        return F.concat(F.array_join(parts, ""), tail)

    whole = F.struct(_chunks(text).alias("chunks"), found.alias("found"), F.length(text).alias("length"))
    return F.when(F.size(found) > 0, _let(whole, replaced)).otherwise(text)


def detected(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """docs with the spans of text_col as column ``into``."""
    return docs.withColumn(into, spans(F.col(text_col)))


def op2(docs: DataFrame) -> DataFrame:
    found = detected(docs.select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("pii.base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(number(k) for k in BASE), F.sha2(digest(F.col("pii.base")), 256).alias("base_sha256"), digest(F.col("pii.all")).alias("spans")
    )
