"""Fill-in-the-middle: texts cut at two points and rearranged, with each text stored as runs of character classes.

A class is the number of bytes that a code point takes in UTF-8 (one to four). A text is a list of maximal runs of one
class, each with the code points before it; a cut, given in code points, is found by a binary search for the run that
contains it and lies (cut - code points before the run) times the class behind the run's start. So no text is decoded or
walked character by character, and a text of one class is a single run.

Where the cuts fall and what form a text takes comes from a hash of the seed and the document's id alone: any number of
executors, in any order and however often a task is run again, give the same output.

Null text counts as empty. Empty texts, texts with a marker in them and a share of the others stay plain. A null id hashes
as an empty one. Rows with one id and different texts are cut by the same hash values, each by its own length; repeated
rows give repeated rows; very long texts are cut whole. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

#: Markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are rearranged, and of these, percent with the suffix first.
RATE, SPM_RATE = 90, 20
SEED = 1

_FIELDS = {"n": T.LongType(), "n_runs": T.LongType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "prefix": T.StringType(), "middle": T.StringType(), "suffix": T.StringType()}
_PARTS = T.StructType([T.StructField(k, t) for k, t in _FIELDS.items()])
#: Bytes that a code point takes, by its first byte; 0 for the bytes after the first.
_WIDTH = np.repeat(np.array([1, 0, 2, 3, 4], np.uint8), [128, 64, 32, 16, 16])


class Runs(NamedTuple):
    """Maximal runs of code points of one width: width, code points and bytes before each run; and the total of both."""

    width: np.ndarray
    units: np.ndarray
    start: np.ndarray
    n: int
    size: int


def encoded(data: np.ndarray) -> Runs:
    """The runs of a text's UTF-8 bytes."""
    width = _WIDTH[data]
    width = width[width > 0]
    first = np.flatnonzero(np.diff(width, prepend=np.uint8(0)))
    of = width[first].astype(np.int64)
    length = np.diff(first, append=len(width))
    return Runs(of, first, np.cumsum(of * length) - of * length, len(width), len(data))


def byte_of(runs: Runs, cut: int) -> int:
    """The byte at which code point number ``cut`` starts; the end of the text for its number of code points."""
    if cut >= runs.n:
        return runs.size
    k = int(np.searchsorted(runs.units, cut, side="right")) - 1
    return int(runs.start[k] + (cut - runs.units[k]) * runs.width[k])


def _one(data: memoryview, h1: int, h2: int) -> tuple:
    runs = encoded(np.frombuffer(data, np.uint8))
    first, last = sorted((h1 % (runs.n + 1), h2 % (runs.n + 1)))
    a, b = byte_of(runs, first), byte_of(runs, last)
    return runs.n, len(runs.width), first, last - first, bytes(data[:a]), bytes(data[a:b]), bytes(data[b:])


@arrow_udf(_PARTS)
def _cut(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    def rows() -> Iterator[tuple]:
        for text, x, y in zip(texts, h1, h2, strict=True):
            yield _one(memoryview(text.as_buffer()), x.as_py(), y.as_py())

    columns = list(zip(*rows(), strict=True)) or [()] * len(_FIELDS)
    numbers = [pa.array(c, pa.int64()) for c in columns[:4]]
    # the cuts lie between code points, so each part is UTF-8 again; the type of texts is the caller's
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    parts = [pa.array(c, texts.type).cast(kind) for c in columns[4:]]
    return pa.StructArray.from_arrays([*numbers, *parts], list(_FIELDS))


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2^32 for a key: the first four groups of eight digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(df: DataFrame, key: str = "doc_id", text: str = "text", into: str = "fim", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """df with a struct ``into``: form (plain, psm or spm), output, n (code points), n_runs, prefix_chars, middle_chars.

    psm is prefix, suffix, middle; spm suffix, prefix, middle; each part behind its marker.
    """
    h1, h2, h3, h4 = draws(F.col(key), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    c = F.col(into)
    prefix, middle, suffix = (F.concat(F.lit(m), c[part]) for m, part in ((PREFIX, "prefix"), (MIDDLE, "middle"), (SUFFIX, "suffix")))
    df = df.withColumn(into, _cut(whole.cast("binary"), h1, h2).withField("form", form))
    output = F.when(c["form"] == "plain", whole).when(c["form"] == "psm", F.concat(prefix, suffix, middle)).otherwise(F.concat(suffix, prefix, middle))
    moved = lambda part: F.when(c["form"] != "plain", c[part]).alias(part)
    return df.withColumn(into, F.struct(c["form"].alias("form"), output.alias("output"), c["n"].alias("n"), c["n_runs"].alias("n_runs"), moved("prefix_chars"), moved("middle_chars")))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Each marker is in it once, as rearranged texts had none."""
    head, middle = F.split_part(output, F.lit(MIDDLE), F.lit(1)), F.split_part(output, F.lit(MIDDLE), F.lit(2))

    def parts(first: str, second: str) -> tuple[Column, Column]:
        body = F.substr(head, F.lit(len(first) + 1))
        return F.split_part(body, F.lit(second), F.lit(1)), F.split_part(body, F.lit(second), F.lit(2))

    (prefix, suffix), (suffix_first, prefix_last) = parts(PREFIX, SUFFIX), parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_last, middle, suffix_first)).otherwise(output)


def op11(docs: DataFrame) -> DataFrame:
    c, digest = F.col("fim"), lambda t: F.sha2(t.cast("binary"), 256)
    rows = transformed(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", c["n"].alias("n"), c["form"].alias("form"), c["prefix_chars"].alias("prefix_chars"), c["middle_chars"].alias("middle_chars"),
        digest(c["output"]).alias("output_sha256"), digest(restored(c["output"], c["form"])).alias("restored_sha256"),
    )


OP11_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, n, least(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS a,
         greatest(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= {RATE} THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
  FROM hashed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '{PREFIX}' || substring(text, 1, a) || '{SUFFIX}' || substring(text, b + 1) || '{MIDDLE}' || substring(text, a + 1, b - a)
              ELSE '{SUFFIX}' || substring(text, b + 1) || '{PREFIX}' || substring(text, 1, a) || '{MIDDLE}' || substring(text, a + 1, b - a) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM drawn
"""
